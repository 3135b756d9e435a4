"""Counts and rates that a run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolecast import schema as S
from rolecast.functions import text as X


def persona_distribution(accepted: DataFrame) -> DataFrame:
    """Rows and percent per persona. The window runs over one row per persona."""
    counts = accepted.groupBy("persona").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percent", F.round(F.col("n").cast("double") * 100.0 / total, 6))


def reason_counts(decisions: DataFrame) -> DataFrame:
    return decisions.filter(F.col("skip_reason").isNotNull()).groupBy("skip_reason").agg(F.count(F.lit(1)).alias("n"))


def run_summary(decisions: DataFrame) -> DataFrame:
    return decisions.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("skip_reason").isNull()).alias("accepted"),
        F.count_if(F.col("skip_reason").isNotNull()).alias("skipped"),
    )


def pass_summary(asked: DataFrame, valid: DataFrame) -> DataFrame:
    """Per pass: contacts asked, accepted in it, and left after it.

    `asked` and `valid` have `pass_no` and `prospect_id`.
    """
    per_pass = asked.groupBy("pass_no").agg(F.count(F.lit(1)).alias("asked"))
    first = valid.groupBy("prospect_id").agg(F.min("pass_no").alias("pass_no"))
    done = first.groupBy("pass_no").agg(F.count(F.lit(1)).alias("processed"))
    return per_pass.join(done, "pass_no", "left").select(
        "pass_no",
        "asked",
        F.coalesce("processed", F.lit(0)).alias("processed"),
        (F.col("asked") - F.coalesce("processed", F.lit(0))).alias("remaining"),
    )


def with_eta(jobs: DataFrame, now: Column) -> DataFrame:
    """Add `total` and `eta_seconds` to batch jobs.

    `jobs` has `completed`, `failed`, `given_total` (may be null) and `started_at` in epoch
    seconds (may be null); `now` is an epoch too.
    """
    completed = F.coalesce(F.col("completed"), F.lit(0))
    total = F.coalesce(
        F.nullif(F.col("given_total"), F.lit(0)), completed + F.coalesce(F.col("failed"), F.lit(0))
    )
    started = F.nullif(F.col("started_at"), F.lit(0))
    elapsed = F.greatest(F.lit(1), now - started)
    rate = completed.cast("double") / elapsed.cast("double")
    left = F.greatest(F.lit(0), total - completed).cast("double")
    eta = F.when((total > 0) & started.isNotNull() & (completed > 0), left / rate)
    return jobs.withColumns({"total": total, "eta_seconds": eta, "eta_text": X.duration_text(eta)})


def batch_progress(log: DataFrame, time_column: str = "at") -> DataFrame:
    """Progress per batch from a request log: `batch_id`, a time, and `outcome`.

    The clock is the latest entry of each batch; open requests count towards the total.
    """
    at = F.unix_timestamp(time_column)
    jobs = log.groupBy("batch_id").agg(
        F.count_if(F.col("outcome") == "completed").alias("completed"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
        F.count(F.lit(1)).alias("given_total"),
        F.min(at).alias("started_at"),
        F.max(at).alias("seen_at"),
    )
    return with_eta(jobs, F.col("seen_at"))


def open_batches(jobs: DataFrame) -> DataFrame:
    """Batches still under way: those whose `status` is not final."""
    return jobs.filter(~F.coalesce(F.col("status"), F.lit("")).isin(*S.FINAL_BATCH_STATES))


def skip_rate_by_chunk(run_log: DataFrame) -> DataFrame:
    """Share of skipped rows per chunk size, and the chunk size that would take up the skipped
    rows of a whole run in one more call, with a tenth as margin."""
    rates = run_log.groupBy("chunk_size").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("skipped").cast("double")).alias("rate")
    )
    total = F.sum("n").over(Window.partitionBy())
    return rates.select(
        "chunk_size",
        "n",
        F.round("rate", 9).alias("skip_rate"),
        F.round(F.lit(0.9) * total * F.col("rate"), 3).alias("target_chunk"),
    )
