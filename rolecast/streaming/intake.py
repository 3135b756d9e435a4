"""Nightly intake: each new export file of a drop folder is taken in once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from rolecast.operators.clean import prepare_contacts, require_columns
from rolecast.sources.contacts import inside_names
from rolecast.sources.csv_blocks import read_csv_by_name

EXPORT_COLUMNS = ("Record ID", "Email", "Job Title")
FILES_PER_BATCH = 1_000
FILES_SCHEMA = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def take_in(
    spark: SparkSession,
    drop_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    columns: Sequence[str] = EXPORT_COLUMNS,
    prepare: Callable[[DataFrame], DataFrame] = prepare_contacts,
    multi_line: bool | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    then: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Take in the CSV files that came since the last call and stop.

    The stream lists the files, and its checkpoint remembers them; their rows are read by
    column name in each batch, as exports differ in the order of columns. A file without one
    of `columns` stops the intake. Each batch has its own folder, so a batch that is repeated
    after a failure replaces itself. `then` gets each batch as it was written, and its
    number, before the stream counts it as done.
    """
    listing = spark.readStream.format("binaryFile").schema(FILES_SCHEMA).option("pathGlobFilter", "*.csv*")

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = [row.path for row in batch.collect()]  # files_per_batch at most
        if paths:
            rows = require_columns(read_csv_by_name(batch.sparkSession, paths, multi_line), columns)
            path = f"{out_dir}/batch_id={batch_id}"
            prepare(inside_names(rows.fillna(""))).write.mode("overwrite").parquet(path)
            if then:
                then(spark.read.parquet(path), batch_id)

    query = (
        listing.option("maxFilesPerTrigger", files_per_batch)
        .load(drop_dir)
        .select("path")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
