"""Sending update blocks, with a ledger of what was delivered."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecast.operators.classify import RetryPolicy
from rolecast.operators.numbering import number_rows
from rolecast.session import exists, finished

LEDGER_SCHEMA = "run int, block_no long, n long, digest long, ok boolean, attempts int, error string"
TODO_SCHEMA = "block_no long, n long, payload string, digest long, wave long"
#: Blocks of a wave for each call that runs at a time.
BLOCKS_PER_CALL = 50


def read_ledger(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """One row per block and run in which it was sent."""
    if not exists(spark, f"{ledger_dir}/sent"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", True).parquet(f"{ledger_dir}/sent")


def block_outcomes(ledger: DataFrame) -> DataFrame:
    """`block_no`, `status`, `n_sent`, `error`: whether a block was delivered in some run, in
    how many runs it was sent, and the error of the last one."""
    ok = F.bool_or("ok")
    return ledger.groupBy("block_no").agg(
        F.when(ok, "success").otherwise("failed").alias("status"),
        F.count(F.lit(1)).alias("n_sent"),
        F.max_by("error", "run").alias("error"),
    )


def send_blocks(todo: DataFrame, send: Callable[[str], None], path: str, run: int, calls: int, policy: RetryPolicy) -> None:
    """Send blocks in a job of their own and write what became of each. A block that fails
    does not stop others, whatever its error."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                try:
                    reply, attempts, error, _ = policy.call(lambda _, payload: send(payload) or "", "", row.payload)
                    ok = reply is not None
                except Exception as problem:
                    ok, attempts, error = False, 1, f"{type(problem).__name__}: {problem}"
                cells = [(run, row.block_no, row.n, row.digest, ok, attempts, None if ok else error)]
                yield pd.DataFrame(cells, columns=[part.split()[0] for part in LEDGER_SCHEMA.split(", ")])

    dealt = todo.select("block_no", "n", "digest", "payload").repartition(calls, "block_no")
    dealt.mapInPandas(work, LEDGER_SCHEMA).write.mode("overwrite").parquet(path)


def deliver(
    blocks: DataFrame,
    send: Callable[[str], None],
    ledger_dir: str,
    calls_in_parallel: int | None = None,
    blocks_per_wave: int | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Send the blocks (`block_no`, `n`, `payload`) that the ledger does not know as delivered,
    and return the ledger.

    `send` raises for a block that was not taken. Called again, only failed blocks and those
    whose payload changed are sent. Blocks go in waves, each a finished table before the next
    begins: a run that broke off goes on with its next wave, so a stop or a lost executor can
    repeat the calls of one wave at most. A run in which blocks were sent and none was taken
    is an error."""
    spark = blocks.sparkSession
    if spark.conf.get("spark.speculation", "false") == "true":
        raise ValueError("switch spark.speculation off: it would send blocks twice")
    calls = calls_in_parallel or spark.sparkContext.defaultParallelism
    run = 1
    while finished(spark, f"{ledger_dir}/done/run-{run}"):
        run += 1
    todo_path = f"{ledger_dir}/todo/run-{run}"
    if not finished(spark, todo_path):
        marked = blocks.select("block_no", "n", "payload", F.xxhash64("n", "payload").alias("digest"))
        taken = read_ledger(spark, ledger_dir).filter("ok").select("block_no", "digest").distinct()
        left = number_rows(marked.join(taken, ["block_no", "digest"], "left_anti"), "block_no")
        wave = F.expr(f"(row_no - 1) div {blocks_per_wave or BLOCKS_PER_CALL * calls}L")
        left.withColumn("wave", wave).drop("row_no").write.mode("overwrite").partitionBy("wave").parquet(todo_path)
    todo = spark.read.schema(TODO_SCHEMA).parquet(todo_path)
    last = todo.agg(F.max("wave")).first()[0]
    for number in range(0 if last is None else last + 1):
        path = f"{ledger_dir}/sent/run-{run}/wave-{number}"
        if not finished(spark, path):
            send_blocks(todo.filter(F.col("wave") == number), send, path, run, calls, policy)
    spark.range(0).write.mode("overwrite").parquet(f"{ledger_dir}/done/run-{run}")
    ledger = read_ledger(spark, ledger_dir)
    told = ledger.filter(F.col("run") == run)
    if last is not None and told.filter("ok").isEmpty():
        raise RuntimeError(f"no block was delivered; an error: {told.agg(F.max('error')).first()[0]}")
    return ledger
