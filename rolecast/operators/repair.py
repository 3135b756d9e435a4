"""Turning near misses of a persona name into the name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rolecast import schema as S
from rolecast.functions.similarity import closest_name, closest_name_by_edits, may_be_close
from rolecast.operators.lookups import BROADCAST_ROWS, HOT_ROWS, fits_broadcast, salted_join
from rolecast.session import saved


def invalid_words(replies: DataFrame, taxonomy: Sequence[str] = S.PERSONAS) -> DataFrame:
    """The distinct persona texts that are not in the taxonomy. Replies are tidy: trimmed or null."""
    return replies.filter(~F.col("persona").isin(*taxonomy)).select(F.col("persona").alias("word")).distinct()


def repair_table(
    words: DataFrame,
    taxonomy: Sequence[str] = S.PERSONAS,
    threshold: int = S.FUZZY_THRESHOLD,
    by_edits: bool = False,
) -> DataFrame:
    """`word`, `repaired` for every text that is close enough to a name.

    `words` should be a saved table of distinct texts: a filter on the score of a plan that
    ends in `distinct` is pushed below it and scores every row.
    """
    score = closest_name_by_edits if by_edits else closest_name
    near = words if by_edits else words.filter(may_be_close(F.col("word"), taxonomy, threshold))
    return near.withColumn("repaired", score(F.col("word"), taxonomy, threshold)).filter(F.col("repaired").isNotNull())


def with_repairs(
    replies: DataFrame,
    spread_by: Sequence[str],
    taxonomy: Sequence[str] = S.PERSONAS,
    threshold: int = S.FUZZY_THRESHOLD,
    by_edits: bool = False,
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add `repaired` to tidy replies: the name an invalid persona stands for, else null.

    The distinct words bound the repairs, so measuring them tells whether to broadcast.
    `replies` is read twice, so hand in a saved table, not the end of a long plan.
    """
    words = saved(invalid_words(replies, taxonomy), "words")
    repairs = repair_table(words, taxonomy, threshold, by_edits)
    keyed = replies.withColumn("word", F.col("persona"))
    if fits_broadcast(words, max_rows):
        joined = keyed.join(F.broadcast(repairs), "word", "left")
    else:
        joined = salted_join(keyed, saved(repairs, "repairs"), "word", spread_by, hot_rows=hot_rows)
    return joined.drop("word")


def repair_skipped(
    skipped: DataFrame,
    spread_by: Sequence[str] = ("prospect_id",),
    taxonomy: Sequence[str] = S.PERSONAS,
    threshold: int = S.FUZZY_THRESHOLD,
) -> tuple[DataFrame, DataFrame]:
    """(corrected, still skipped) of rows skipped for an invalid persona.

    Corrected rows have the repaired name and no skip reason.
    """
    invalid = F.coalesce(F.col("skip_reason").startswith(S.INVALID_PREFIX.strip()), F.lit(False))
    asked = skipped.withColumn("_asked", F.when(invalid, F.col("persona")))
    columns = [name for name in skipped.columns if name != "persona"]
    replies = asked.select(*columns, F.col("persona").alias("_given"), F.col("_asked").alias("persona"))
    tried = saved(with_repairs(replies, spread_by, taxonomy, threshold), "tried")
    corrected = tried.filter(F.col("repaired").isNotNull()).withColumns(
        {"_given": F.col("repaired"), "skip_reason": F.lit(None).cast("string")}
    )
    still = tried.filter(F.col("repaired").isNull())
    shape = [F.col("_given").alias("persona") if name == "persona" else F.col(name) for name in skipped.columns]
    return corrected.select(*shape), still.select(*shape)
