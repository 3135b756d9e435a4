"""Calling a classifier on chunks, retrying it, and the built-in rule classifier."""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rolecast import schema as S
from rolecast.functions import text as X

ReplyFunction = Callable[[str, str], str]
REPLY_SCHEMA = "pass_no int, chunk_id long, n long, reply string, attempts int, error string, wait_seconds double, wave long, chunk_size int"


class CallFailed(Exception):
    """What a reply function raises for a call that may succeed later: a rate limit, a lost
    connection, an error of the service."""


@dataclass(frozen=True)
class RetryPolicy:
    """How often and how long to retry one call. Only errors of the kinds in `retry_on` are
    retried; a mistake in the reply function itself ends the run."""

    max_attempts: int = S.MAX_ATTEMPTS
    first_backoff: float = S.FIRST_BACKOFF_SECONDS
    max_backoff: float = S.MAX_BACKOFF_SECONDS
    jitter: float = 1.0
    retry_on: tuple[type[BaseException], ...] = (CallFailed, ConnectionError, TimeoutError)
    sleep: Callable[[float], None] = time.sleep

    def wait(self, attempt: int, message: str) -> float:
        hint = re.search(S.RETRY_HINT, message)
        grown = min(self.max_backoff, self.first_backoff * 2**attempt + random.uniform(0, self.jitter))
        return max(float(hint.group(1)) if hint else 0.0, grown)

    def call(self, ask: ReplyFunction, system: str, payload: str) -> tuple[str | None, int, str | None, float]:
        """(reply, attempts, last error, seconds waited); the reply is null when all tries failed."""
        error, waited = None, 0.0
        for attempt in range(self.max_attempts):
            try:
                return ask(system, payload), attempt + 1, error, waited
            except self.retry_on as problem:
                error = str(problem)
                if attempt + 1 < self.max_attempts:
                    pause = self.wait(attempt, error)
                    waited += pause
                    self.sleep(pause)
        return None, self.max_attempts, error, waited


def ask_chunks(
    payloads: DataFrame,
    ask: ReplyFunction,
    path: str,
    system: str = "",
    pass_no: int = 1,
    wave: int = 0,
    chunk_size: int | None = None,
    calls_in_parallel: int | None = None,
    pace: bool = False,
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Send every payload to `ask` once and keep the replies as a table at `path`.

    The calls are a job of their own whose result is written before anyone uses it: a later
    join or retry reads the table and never repeats a call that was paid for.
    `calls_in_parallel` tasks, by default as many as the cluster runs at a time, share the
    token budget when `pace` is on.
    """
    spark = payloads.sparkSession
    calls_in_parallel = calls_in_parallel or spark.sparkContext.defaultParallelism
    if spark.conf.get("spark.speculation", "false") == "true":
        raise ValueError("switch spark.speculation off: it would send requests twice")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                reply, attempts, error, waited = policy.call(ask, system, row.payload)
                if pace:
                    policy.sleep(row.pause_seconds)
                yield pd.DataFrame(
                    [(pass_no, row.chunk_id, row.n, reply, attempts, error, waited, wave, chunk_size)],
                    columns=["pass_no", "chunk_id", "n", "reply", "attempts", "error", "wait_seconds", "wave", "chunk_size"],
                )

    todo = payloads.select(
        "chunk_id", "n", "payload", X.pause_seconds(F.col("n"), calls_in_parallel).alias("pause_seconds")
    )
    todo.repartition(calls_in_parallel, "chunk_id").mapInPandas(run, REPLY_SCHEMA).write.mode("overwrite").parquet(path)
    return spark.read.schema(REPLY_SCHEMA).parquet(path)


def rule_persona(
    title: Column, rules: Sequence[tuple[int, str, str]] = S.TITLE_RULES, default: str = S.RULE_DEFAULT
) -> Column:
    """Persona from words in the title: the first rule, by priority, whose pattern occurs."""
    words = F.coalesce(title, F.lit(""))
    result = None
    for _, pattern, persona in sorted(rules):
        hit = words.rlike(pattern)
        result = F.when(hit, persona) if result is None else result.when(hit, persona)
    return F.lit(default) if result is None else result.otherwise(default)


def rule_replies(
    rules: Sequence[tuple[int, str, str]] = S.TITLE_RULES, default: str = S.RULE_DEFAULT, certainty: str = "90"
) -> ReplyFunction:
    """The rule table as a reply function, for runs without a model."""
    ordered = [(re.compile(pattern), persona) for _, pattern, persona in sorted(rules)]

    def ask(system: str, payload: str) -> str:
        lines = []
        for entry in payload.split("\n"):
            prospect_id, _, title = entry.partition(",")
            persona = next((p for pattern, p in ordered if pattern.search(title)), default)
            lines.append(f"{prospect_id},{title},{persona},{certainty}")
        return "\n".join(lines)

    return ask


def remaining_ids(remaining: DataFrame, ok: DataFrame, failed: DataFrame, key: str = "prospect_id") -> DataFrame:
    """Ids to ask again: those without an accepted reply, and those whose call failed."""
    return remaining.select(key).subtract(ok.select(key)).union(failed.select(key)).distinct()
