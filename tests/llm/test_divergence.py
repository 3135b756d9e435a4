"""Source divergence against a plain version, with blocks of every size."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from rolecast.llm import divergence as module
from rolecast.llm.divergence import chances, count_terms, diverge, merge_terms, source_divergence
from strange import nothing, strange, strange_rows

SCHEMA = "text string, lang string, source string"
WORDS = ["the", "The", "of", "été", "ÉTÉ", "日本", "a", "b", "c", "d1e", "x-y", "z_", "I'm", "ß", "ŞK", "\x7f", "\x00q"]


def listed(rows):
    return sorted(map(tuple, rows))


def random_rows(n, seed, n_sources=5):
    draw = random.Random(seed)
    sources = [f"s{i}" for i in range(n_sources)] + ["é", "Z", ""]
    rows = []
    for _ in range(n):
        source = draw.choice(sources[:2] + sources)
        text = " ".join(draw.choices(WORDS[len(source) % 3 :], k=draw.randint(0, 12)))
        rows.append((draw.choice([text, text, text, None]), draw.choice(["en", "en", "en", "fr", None, ""]), draw.choice([source, source, None])))
    return rows


@pytest.mark.parametrize("n, min_docs, top", [(40, 3, 2), (300, 30, 50), (300, 1, 4), (20, 1_000, 5)])
def test_random_documents(spark, n, min_docs, top):
    rows = random_rows(n, n)
    got = source_divergence(spark.createDataFrame(rows, SCHEMA).repartition(3), min_docs, top)
    assert listed(got.collect()) == listed(brute.divergence(rows, min_docs, top))


def steps(rows, min_docs, top):
    """The three task functions on lists, and the sums and ranks that Spark makes of them."""
    columns = [[cell or "" for cell in column] for column in zip(*rows)]
    batch = pa.RecordBatch.from_arrays([pa.array(column, pa.string()) for column in columns], names=["text", "lang", "source"])
    partial = pa.Table.from_batches([*count_terms(iter([batch.slice(0, 7), batch.slice(7)]))]).sort_by([("lang", "ascending"), ("term", "ascending")])
    shards = [*merge_terms(min_docs)(iter(partial.to_batches(max_chunksize=9)))]
    totals, sizes, found = {}, {}, []
    for lang, source in zip(*columns[1:]):
        totals.setdefault(lang, {})[source] = 0
    for shard in shards:
        row = {name: shard.column(name)[0].as_py() for name in shard.schema.names}
        sizes[row["lang"]] = sizes.get(row["lang"], 0) + len(row["terms"])
        for source, total in zip(row["sources"], row["sums"]):
            totals[row["lang"]][source] += total
    groups = {lang: [{"source": s, "total": t} for s, t in sorted(of.items())] for lang, of in totals.items()}
    full = [
        pa.RecordBatch.from_arrays(
            [*shard.columns, pa.array([groups[lang]]), pa.array([sizes[lang]])], names=[*shard.schema.names, "groups", "n_terms"]
        )
        for shard in shards
        for lang in [shard.column("lang")[0].as_py()]
    ]
    for out in diverge(top)(iter(full)):
        found += out.to_pylist()
    return shards, found


@pytest.mark.parametrize("limits", [
    {}, {"COUNT_BYTES": 10, "HELD_COUNTS": 5}, {"SHARD_COUNTS": 4}, {"BLOCK_CELLS": 3, "SHARD_COUNTS": 30}, {"BLOCK_SOURCES": 2, "HELD_BLOCKS": 1},
    {"HELD_GROUPS": 1, "SHARD_COUNTS": 12}, {"SHARD_COUNTS": 1, "BLOCK_SOURCES": 1, "BLOCK_CELLS": 1, "HELD_BLOCKS": 0, "HELD_GROUPS": 0},
])
def test_limits_change_nothing(monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(module, name, value)
    rows = [row for row in random_rows(200, 9) if row[1]]
    shards, found = steps(rows, 4, 6)
    want = brute.divergence(rows, 4, 6)
    sums = {}
    for row in found:
        if row["part"] == "pair":
            for way in ((row["source"], row["item"]), (row["item"], row["source"])):
                sums[row["lang"], *way] = sums.get((row["lang"], *way), 0) + row["value"]
    assert sums == {(lang, s, item): value for lang, s, part, item, value, _ in want if part == "pair"}
    terms = {}
    for row in found:
        if row["part"] == "term":
            terms.setdefault((row["lang"], row["source"]), []).append((-row["value"], row["item"].encode()))
    best = {(*group, item.decode(), -value) for group, rows in terms.items() for value, item in sorted(rows)[:6]}
    assert best == {(lang, s, item, value) for lang, s, part, item, value, _ in want if part == "term"}
    if limits.get("SHARD_COUNTS"):
        assert len(shards) > 2


def test_chances_are_exact():
    draw = random.Random(1)
    for _ in range(300):
        total, terms = draw.randrange(10 ** draw.randint(1, 15)), draw.randint(1, 10**6)
        count = draw.randint(0, total)
        assert chances(pa.array([count]).to_numpy(), total, terms).tolist() == [1 + 10**9 * (count + 5) // (total + 5 * terms)]
    assert chances(pa.array([7]).to_numpy(), 7, 1).tolist() == [1 + 10**9]


def test_strange_documents(spark):
    df = strange(spark).select("*", *[F.lit(1).alias(name) for name in ("term", "groups", "value", "rank", "n", "docs", "terms", "total")])
    rows = [(text, lang, source) for _, text, lang, source, _ in strange_rows()]
    assert listed(source_divergence(df, 2).collect()) == listed(brute.divergence(rows, 2))
    assert source_divergence(nothing(spark)).collect() == []


def test_language_without_kept_terms_has_its_pairs(spark):
    rows = [("one", "en", "a"), (None, "en", "b"), ("", "en", None)]
    got = listed(source_divergence(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == listed(brute.divergence(rows)) and len(got) == 6 and {row[4] for row in got} == {0}
