"""Closeness of a reply to the names of a taxonomy."""

from __future__ import annotations

import difflib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, functions as F

from rolecast import schema as S


def may_be_close(word: Column, taxonomy: Sequence[str] = S.PERSONAS, threshold: int = S.FUZZY_THRESHOLD) -> Column:
    """Whether some name could reach the threshold: twice the shared letters, whatever their
    order, over both lengths bounds the ratio from above."""
    letters = sorted(set("".join(taxonomy)))
    names = F.array(
        *[F.struct(F.lit(len(name)).alias("size"), F.array(*[F.lit(name.count(c)) for c in letters]).alias("counts")) for name in sorted(taxonomy)]
    )
    here = F.transform(F.array(*map(F.lit, letters)), lambda c: F.length(word) - F.length(F.replace(word, c, F.lit(""))))

    def reached(name: Column, counts: Column) -> Column:
        shared = F.aggregate(F.zip_with(name["counts"], counts, lambda a, b: F.least(a, b)), F.lit(0), lambda a, b: a + b)
        return 200 * shared >= threshold * (name["size"] + F.length(word))

    # The list of one entry makes the word's counts a variable, so they are counted once.
    return F.exists(F.array(here), lambda counts: F.exists(names, lambda name: reached(name, counts)))


def closest_name(word: Column, taxonomy: Sequence[str] = S.PERSONAS, threshold: int = S.FUZZY_THRESHOLD) -> Column:
    """The name most like `word` by matching-block ratio, null below `threshold` percent.

    The ratio has no built-in form, so this is an Arrow UDF. Call it on distinct words only.
    It counts as non-deterministic, so that a filter on the score does not score twice.
    """
    names = list(taxonomy)
    cutoff = threshold / 100.0

    @F.pandas_udf("string")
    def score(words: pd.Series) -> pd.Series:
        return words.map(lambda w: next(iter(difflib.get_close_matches(w, names, 1, cutoff)), None) if w else None)

    return score.asNondeterministic()(word)


def closest_name_by_edits(
    word: Column, taxonomy: Sequence[str] = S.PERSONAS, threshold: int = S.FUZZY_THRESHOLD
) -> Column:
    """As `closest_name` with edit distance as the score: built-in expressions only."""
    names = F.array(*[F.lit(name) for name in taxonomy])

    def scored(name: Column) -> Column:
        longest = F.greatest(F.length(word), F.length(name))
        return F.struct((1 - F.levenshtein(word, name) / longest).alias("score"), name.alias("name"))

    best = F.array_max(F.transform(names, scored))
    return F.when(best["score"] >= F.lit(threshold / 100.0), best["name"])
