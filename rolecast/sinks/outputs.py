"""Writing decisions, request files and raw replies."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, functions as F

from rolecast import schema as S
from rolecast.operators.decide import accepted, skipped


def run_stamp(pattern: str = "%Y-%m-%d %H %M %S") -> str:
    return datetime.now().strftime(pattern)


def display_names(df: DataFrame) -> DataFrame:
    """Names as shown in files; columns the files do not know are kept as they are."""
    shown = {inside: name for name, inside in S.DISPLAY_NAMES.items() if inside != "record_id"}
    return df.withColumnsRenamed({name: shown[name] for name in df.columns if name in shown})


def write_csv(df: DataFrame, path: str, quote_all: bool = True) -> str:
    """A folder of CSV files with header, ids as text and missing values empty."""
    display_names(df).write.mode("error").csv(
        path,
        header=True,
        quoteAll=quote_all,
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


def save_outputs(
    decisions: DataFrame,
    out_dir: str,
    stamp: str | None = None,
    rerun: bool = False,
    columns: tuple[str, ...] = S.DECISION_COLUMNS,
) -> tuple[str, str]:
    """Accepted and skipped contacts as two CSV folders named by the time of the run.

    `decisions` should be a saved table: it is read once per output. A rerun is quoted only
    where needed.
    """
    stamp = stamp or run_stamp()
    label = f"Rerun {stamp}" if rerun else stamp
    accepted_path = f"{out_dir}/Personas {label}"
    skipped_path = f"{out_dir}/Skipped prospects/Skipped prospects {label}"
    write_csv(accepted(decisions).select(*columns), accepted_path, not rerun)
    write_csv(skipped(decisions).select(*columns), skipped_path, not rerun)
    return accepted_path, skipped_path


def write_decisions(decisions: DataFrame, path: str) -> DataFrame:
    """Write decisions as a table at `path` and return their summary as one row: total,
    accepted, skipped, and the skipped by kind of reason. It is counted while they are
    written, so nothing is read or decided again for it."""
    reason = F.col("skip_reason")
    kinds = {
        "no_response": reason == S.NO_RESPONSE,
        "invalid_persona": reason.startswith(S.INVALID_PREFIX),
        "batch_error": reason.startswith(S.BATCH_PREFIX),
    }
    told = Observation()
    observed = decisions.observe(
        told,
        F.count(F.lit(1)).alias("total"),
        F.count_if(reason.isNull()).alias("accepted"),
        F.count_if(reason.isNotNull()).alias("skipped"),
        *[F.count_if(F.coalesce(is_kind, F.lit(False))).alias(name) for name, is_kind in kinds.items()],
    )
    observed.write.mode("error").parquet(path)
    names = ["total", "accepted", "skipped", *kinds]
    return decisions.sparkSession.createDataFrame([tuple(told.get[name] for name in names)], ", ".join(f"{name} long" for name in names))


def write_lines(lines: DataFrame, path: str, column: str = "line") -> str:
    """JSON documents, one per line: request files and raw output kept for a later resume."""
    lines.select(F.col(column).alias("value")).write.mode("error").text(path)
    return path


def save_raw(lines: DataFrame, out_dir: str, name: str, column: str = "line") -> str:
    """Raw output of a batch, or its metadata as JSON lines, kept under the time of the run."""
    return write_lines(lines, f"{out_dir}/_checkpoints/{name}_{run_stamp('%Y-%m-%d_%H-%M-%S')}", column)
