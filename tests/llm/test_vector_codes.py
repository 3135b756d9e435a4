"""Vector codes against a plain version that looks at all entries in every round."""

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import brute
from rolecast.llm import vector_codes as module
from rolecast.llm.vector_codes import vector_codes
from rolecast.session import run_dir

SCHEMA = "vec_id long, embedding array<float>, label int"


def listed(rows):
    return sorted(map(tuple, rows), key=str)


def random_rows(n, length=16, seed=0):
    draw = random.Random(seed)
    rows = [(i, [draw.choice([-1, 0, 0.25, draw.gauss(0, 0.1)]) for _ in range(length)], draw.choice([None, 0, 0, 0, 1])) for i in range(n)]
    return [(key, np.float32(vector).tolist(), label) for key, vector, label in rows]


@pytest.mark.parametrize("n, seed", [(1, 0), (5, 1), (16, 2), (17, 3), (300, 4)])
def test_random_vectors(spark, n, seed):
    rows = random_rows(n, seed=seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert listed(vector_codes(df).collect()) == listed(brute.vector_codes(rows))


def test_small_packs_give_the_same(spark, monkeypatch):
    rows = random_rows(120, seed=5)
    monkeypatch.setattr(module, "PACK_CELLS", 16 * 7)
    assert listed(vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()) == listed(brute.vector_codes(rows))


def test_strange_vectors(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.5] * 8
    rows = [
        (1, None, 1), (2, [nan] * 8, 1), (3, [inf] + [0.0] * 7, 1), (4, [None] + [0.0] * 7, None), (5, [-inf] * 8, 2), (6, [0.0, None] + [inf] * 6, 2),
        (None, same, None), (None, [0.25] * 8, None), (7, same, None), (7, same, 3), (7, [-0.0] * 8, 3), (8, [-0.1] * 8, 4), (-3, [1.0] * 8, 4), (9, same, 3),
    ]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(name) for name in ("key", "code", "error", "same", "label_error", "vector", "place")])
    got = vector_codes(df)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert listed(got.collect()) == listed(brute.vector_codes(rows)) and len(got.collect()) == 8


def test_one_vector_many_times(spark):
    rows = [(i, [0.5, -0.5] * 8, 0) for i in range(2_000)] + random_rows(40, seed=6)
    assert listed(vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()) == listed(brute.vector_codes(rows))


def test_no_vectors(spark):
    for rows in ([], [(1, None, 2)]):
        got = vector_codes(spark.createDataFrame(rows, SCHEMA))
        assert got.collect() == [] and dict(got.dtypes)["label_error"] == "bigint"


def test_what_cannot_be_coded(spark):
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes(spark.createDataFrame([(1, [0.0] * 9, 1)], SCHEMA))
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes(spark.createDataFrame([(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], SCHEMA))
    with pytest.raises(ValueError, match="too large"):
        vector_codes(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA))


def test_rounds_before_are_removed(spark):
    vector_codes(spark.createDataFrame(random_rows(200, seed=7), SCHEMA)).collect()
    folder = run_dir(spark).removeprefix("file:")
    assert sum(name.startswith("vector-packs") for name in os.listdir(folder)) >= 1
    before = set(os.listdir(folder))
    vector_codes(spark.createDataFrame(random_rows(200, seed=8), SCHEMA)).collect()
    assert sum(name.startswith("vector-packs") for name in set(os.listdir(folder)) - before) == 1


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 30), st.integers(1, 6))
def test_active_entries_find_what_all_entries_find(seed, n, entries):
    draw = np.random.default_rng(seed)
    values, book = draw.integers(-3, 4, (n, 2)), draw.integers(-3, 4, (entries, 2))
    code, best = module.assign_all(values, book)
    for _ in range(4):
        after = book.copy()
        changed = draw.random(entries) < 0.4
        after[changed] = draw.integers(-3, 4, (changed.sum(), 2))
        moved = (after != book).any(axis=1)
        module.assign_active(values, after, moved, code, best)
        want = module.assign_all(values, after)
        assert code.tolist() == want[0].tolist() and best.tolist() == want[1].tolist()
        book = after
