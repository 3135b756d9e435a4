"""Quality rules with an isolation forest (operator 3).

Each text gets counts (words, symbols, repeated lines and words, capitals, marks). Two fixed
rules reject a text at once. The others are judged by a forest over saturated rates of the
counts: each tree cuts the unit cube at random until the sample of clean texts that it was
given is isolated, so a text that ends in a part of the cube with few of them has a short
path. The score is 2 ** (-path / usual path), and labelled rows set its threshold."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolecast.llm.texts import SPACES, raw, slices
from rolecast.session import saved

SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?"
#: Trees, and texts in the sample of each; together the bound of the rows fitted on.
TREES = 100
SAMPLE = 256
DEPTH = 10
#: Bins of scores when the threshold is chosen, and how many rejected bad texts make up for
#: one rejected clean text (as shares of either kind).
BINS = 10_000
CLEAN_WEIGHT = 10
#: Rates that the forest sees, and the value at which each is full.
RATES = {
    "symbols": ("n_symbols", "n_words", 0.3),
    "capitals": ("n_capitals", "n_letters", 0.3),
    "marks": ("n_marks", "n_words", 1.0),
    "repeats": ("n_repeat_words", "n_words", 1.0),
    "lines": ("n_dup_lines", "n_lines", 1.0),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_letters", "n_marks", "n_lines")

_WORD, _SYMBOL, _CAPITAL, _LETTER, _MARK = (1 << i for i in range(5))
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """Flags of each code point."""
    if not _KINDS:
        spelled = [chr(point) for point in range(0x110000)]
        kinds = np.full(0x110000, _WORD, np.uint8)
        kinds[list(SPACES)] = 0
        kinds[[ord(char) for char in SYMBOLS]] |= _SYMBOL
        kinds[[ord(char) for char in MARKS]] |= _MARK
        kinds[np.array([char.isupper() for char in spelled])] |= _CAPITAL
        kinds[np.array([char.isalpha() for char in spelled])] |= _LETTER
        _KINDS.append(kinds)
    return _KINDS[0]


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of three words that occur twice or more, the first included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, reach = Counter(windows), 0, 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + 3 - max(start, reach)
            reach = start + 3
    return covered


def text_counts(texts: list[bytes]) -> list[np.ndarray]:
    """The COUNTS of each text."""
    spelled = [text.decode() for text in texts]
    sizes = np.array([len(text) for text in spelled], np.int64)
    flags = _kinds()[np.frombuffer("".join(spelled).encode("utf-32-le"), "<u4")]
    edges = np.concatenate([[0], np.cumsum(sizes)])

    def total(flag: int) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags & flag != 0, dtype=np.int64)])
        return sums[edges[1:]] - sums[edges[:-1]]

    words = [text.split() for text in texts]  # of bytes: exactly the six ASCII characters split
    lines = [[line for line in text.split(b"\n") if line.strip()] for text in texts]
    return [
        np.array([len(each) for each in words], np.int64),
        total(_WORD),
        total(_SYMBOL),
        np.array([len(each) - len(set(each)) for each in lines], np.int64),
        np.array([repeat_words(each) for each in words], np.int64),
        total(_CAPITAL),
        total(_LETTER),
        total(_MARK),
        np.array([len(each) for each in lines], np.int64),
    ]


def with_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and COUNTS of each row; a null text has none of anything."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = [pa.array(column, pa.int64()) for column in text_counts(raw(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *counts], names=["key", *COUNTS])

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(count, f"key {kind}, " + ", ".join(f"{name} long" for name in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rates() -> list[Column]:
    """The forest's features, 0 to 1."""
    return [
        F.least(F.col(part) / F.greatest(F.col(whole), F.lit(1)) / full, F.lit(1.0)).alias(name)
        for name, (part, whole, full) in RATES.items()
    ]


def usual_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points in a binary tree."""
    if n < 2:
        return 0.0
    return 2 * (np.log(n - 1) + 0.5772156649015329 if n > 2 else 1.0) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Nodes of all trees: the feature and place of each cut, the two nodes below, and at a
    leaf the path length."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    below: np.ndarray  # 2 x nodes
    path: np.ndarray
    sample: int

    @classmethod
    def fit(cls, points: np.ndarray, seed: int = 0) -> Forest:
        """Grow TREES trees, each on SAMPLE rows of `points` (0 to 1 in every column)."""
        draw = np.random.default_rng(seed)
        roots, nodes = [], []

        def grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([0, 0.0, at, at, depth + usual_path(len(rows))])
            if depth < DEPTH and len(rows) > 1:
                feature = int(draw.integers(rows.shape[1]))
                cut = draw.uniform(low[feature], high[feature])
                middle_high, middle_low = high.copy(), low.copy()
                middle_high[feature] = middle_low[feature] = cut
                left = rows[:, feature] < cut
                under = grow(rows[left], low, middle_high, depth + 1), grow(rows[~left], middle_low, high, depth + 1)
                nodes[at] = [feature, cut, *under, np.nan]
            return at

        size = min(SAMPLE, len(points))
        for _ in range(TREES):
            chosen = points[draw.choice(len(points), size, replace=False)]
            roots.append(grow(chosen, np.zeros(points.shape[1]), np.ones(points.shape[1]), 0))
        table = np.array(nodes, float).T
        return cls(np.array(roots), table[0].astype(int), table[1], table[2:4].astype(int), table[4], size)

    def scores(self, points: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(points)), np.arange(len(points))
        for root in self.roots:
            at = np.full(len(points), root)
            for _ in range(DEPTH):  # a leaf leads to itself
                at = self.below[(points[rows, self.feature[at]] >= self.cut[at]).astype(int), at]
            total += self.path[at]
        return 2.0 ** (-total / len(self.roots) / max(usual_path(self.sample), 1.0))


def fit_forest(counted: DataFrame, labels: DataFrame, key: str = "doc_id", seed: int = 0) -> Forest | None:
    """A forest on the rates of at most TREES * SAMPLE clean labelled texts that pass the
    fixed rules: the ones first in a hash order, equal rates counting once. Without clean
    labels, on such a sample of all texts; without texts, none."""
    spark = counted.sparkSession
    passed = counted.where(~base_failed())
    clean = labels.where("quality = 1").select(F.col(key).alias("key")).distinct()
    names = list(RATES)
    for rows in (passed.join(clean, "key", "left_semi"), passed):
        distinct = rows.select(*rates()).distinct()
        sample = distinct.orderBy(F.xxhash64(*names), *names).limit(TREES * SAMPLE).toPandas()
        if len(sample):
            return Forest.fit(sample[names].to_numpy(float), seed)
    return None


def with_scores(counted: DataFrame, forest: Forest | None) -> DataFrame:
    """`counted` with anomaly (0 to 1); 0 without a forest."""
    if forest is None:
        return counted.withColumn("anomaly", F.lit(0.0))
    names = counted.columns
    schema = T.StructType([*counted.schema.fields, T.StructField("anomaly", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.stack([np.array(batch.column(name), float) for name in RATES], axis=1)
            columns = [*batch.columns[: len(names)], pa.array(forest.scores(points))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "anomaly"])

    return counted.select(*names, *rates()).mapInArrow(score, schema)


def choose_threshold(scored: DataFrame, labels: DataFrame, key: str = "doc_id") -> float:
    """The score above which texts go, from all labelled texts that pass the fixed rules.

    It is the middle of the best range of: share of bad texts above it, less CLEAN_WEIGHT
    times the share of clean ones. Without bad or clean labels it is 1, and all stay. The
    driver receives 2 * BINS counts at most."""
    marked = labels.where("quality in (0, 1)").select(F.col(key).alias("key"), "quality").distinct()
    bins = F.least(F.floor(F.col("anomaly") * BINS), F.lit(BINS - 1)).alias("bin")
    rows = scored.where(~base_failed()).select("key", bins).join(marked, "key").groupBy("bin", "quality").count().collect()
    counts = np.zeros((2, BINS))
    for row in rows:
        counts[row.quality, row.bin] += row["count"]
    if not counts.sum(axis=1).all():
        return 1.0
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] / counts.sum(axis=1, keepdims=True)  # at or above bin
    gain = above[0] - CLEAN_WEIGHT * above[1]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    if gain.max() <= 0:
        return 1.0
    run = best[: np.argmax(np.diff(np.append(best, BINS + 1)) > 1) + 1]  # the first run of best bins
    return float((run[0] + run[-1]) / 2 / BINS)


def document_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key`, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, anomaly.

    Null and empty texts have zero counts and fail the fixed rules. Repeated rows get equal
    results. Null keys match no label. Other columns of `docs` are not read."""
    counted = saved(with_counts(docs, key, text), "counts")
    scored = saved(with_scores(counted, fit_forest(counted, labels, key)), "scores")
    threshold = choose_threshold(scored, labels, key)
    shown = [name for name in COUNTS[:5]]
    return scored.select(
        F.col("key").alias(key),
        *shown,
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("anomaly") <= threshold)).alias("kept"),
        "anomaly",
    )
