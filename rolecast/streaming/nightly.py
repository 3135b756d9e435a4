"""The nightly run as one stream: new files, the contacts in them, and their decisions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from rolecast.operators.classify import ReplyFunction
from rolecast.operators.clean import prepare_contacts
from rolecast.plans.online import run_online
from rolecast.session import finished
from rolecast.streaming.intake import EXPORT_COLUMNS, FILES_PER_BATCH, take_in


def run_nightly(
    spark: SparkSession,
    drop_dir: str,
    work_dir: str,
    ask: ReplyFunction,
    columns: Sequence[str] = EXPORT_COLUMNS,
    prepare: Callable[[DataFrame], DataFrame] = prepare_contacts,
    files_per_batch: int = FILES_PER_BATCH,
    **options,
) -> DataFrame:
    """Take in the files that came since the last call, decide their contacts and return the
    decisions of all nights, with `batch_id`.

    The state of the stream is the folder of the run: it knows who was asked with which title
    and what came back. A contact that comes again in a later file, or twice in one night, is
    not asked again while its title stays; its decision is written anew with the columns it
    has now. A batch that broke off goes on after its last finished wave, and one that is
    repeated after a failure replaces its decisions. `options` go to `run_online`."""

    def enrich(contacts: DataFrame, batch_id: int) -> None:
        path = f"{work_dir}/decisions/batch_id={batch_id}"
        if not finished(spark, path):
            decided = run_online(contacts, ask, f"{work_dir}/run", grow=True, **options)
            decided.write.mode("overwrite").parquet(path)

    take_in(spark, drop_dir, f"{work_dir}/intake", f"{work_dir}/state", columns, prepare, files_per_batch=files_per_batch, then=enrich)
    return spark.read.option("basePath", f"{work_dir}/decisions").parquet(f"{work_dir}/decisions")
