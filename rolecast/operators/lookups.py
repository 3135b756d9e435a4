"""Joins against a table with one row per key, safe when the other side repeats keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 1_000_000
HOT_KEYS = 1_000
SALTS = 64


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure `df`: its row count, then the bytes of a table that is small enough to ask."""
    if df.count() > max_rows:
        return False
    return (df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0) <= max_bytes


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> list:
    """Keys that hold more than about `hot_rows` rows, the HOT_KEYS largest of them: any other
    key holds less than one row in HOT_KEYS, which is a fair share of a large table.

    A sketch finds them in one pass without shuffling keys. Its errors only change how rows
    are spread, not which rows match.
    """
    top = df.agg(F.expr(f"approx_top_k({key}, {HOT_KEYS}, {HOT_KEYS * 10})").alias("top")).first()["top"]
    return [entry["item"] for entry in top or [] if entry["count"] > hot_rows and entry["item"] is not None]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread_by: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Shuffle join in which the hot keys of `left` are spread over `salts` tasks.

    `right` has one row per key; only the rows of hot keys are repeated per salt.
    `spread_by` names columns of `left` that tell the rows of one key apart. Null keys
    match nothing and are spread as well.
    """
    hot = hot_keys(left, on, hot_rows)
    key = F.col(on)
    is_hot = key.isin(hot) if hot else F.lit(False)
    spot = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    left_salted = left.withColumn("_salt", F.when(key.isNull() | is_hot, spot).otherwise(F.lit(0)))
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    right_salted = right.withColumn("_salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0)))))
    return left_salted.join(right_salted, [on, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread_by: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Broadcast `right` when its measured size allows it, otherwise `salted_join`.

    `right` is read up to three times, so hand in a saved table, not the end of a long plan.
    """
    if fits_broadcast(right, max_rows, max_bytes):
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, on, spread_by, how, hot_rows)
