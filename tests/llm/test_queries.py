"""The registered queries at the smallest size, and the pipeline, against plain versions."""

from collections import Counter
import functools
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import brute
import corpus_pipeline
from rolecast.llm.byte_bpe import read_ranks
from rolecast.llm.languages import COMMON, ngrams
from rolecast.llm.leaks import normal
from rolecast.llm.queries import QUERIES
from rolecast.session import saved
from strange import nothing, strange

SMALL = entry.SMALL
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={}
)


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((tuple(row) for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()))


def rows(spark, name, *columns):
    return sorted(tuple(row) for row in entry.queries()[name](spark, SMALL).select(*columns).collect())


def bpe_digest(key, text):
    ids = LIBRARY.encode_ordinary(text)
    return key, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and {*QUERIES, "pipeline"} <= set(entry.queries())


def test_op1(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    want = con.execute(f"select {', '.join(columns)} from ({entry.oracle_sql()['op1_shards']})").fetchall()
    assert rows(spark, "op1_shards", *columns) == sorted(want)


def test_op2(spark, docs):
    got = {row[0]: row for row in rows(spark, "op2_languages", "doc_id", "held_out", "lang_pred", "score")}
    assert all(got[key][1] == (brute.crc(key) % 3 == 1) for key, _, _ in docs)
    held = [(got[key][2], lang) for key, _, lang in docs if got[key][1]]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) and len(got) == len(docs)


def test_op3(spark, docs):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows(spark, "op3_quality", *columns) == [(key, *brute.base_quality(text)) for key, text, _ in docs]
    kept = dict(rows(spark, "op3_quality", "doc_id", "kept"))
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    passed = [(r.quality, kept[r.doc_id]) for r in labels if not brute.base_quality(dict((d[0], d[1]) for d in docs)[r.doc_id])[-1]]
    counts = Counter(passed)
    assert counts[1, True] >= 0.98 * (counts[1, True] + counts[1, False]) and counts[0, False] >= 0.8 * (counts[0, True] + counts[0, False])


def test_op4(spark, docs):
    tokenizer, start, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for key, text, _ in docs:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows(spark, "op4_token_files", "doc_id", "start", "n_tokens", "ids_crc32") == want
    counts = [(key, len(text.encode()), n - 1, n - 1 > 2048) for (key, text, _), (_, _, n, _) in zip(docs, want)]
    assert rows(spark, "op8_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == counts


def test_op5(spark, docs):
    assert rows(spark, "op5_byte_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == [bpe_digest(key, text) for key, text, _ in docs]


def test_op6(spark, docs):
    want = [(key, *result) for (key, _, _), result in zip(docs, brute.repeats([text for _, text, _ in docs]))]
    assert rows(spark, "op6_repeats", "doc_id", "n_words", "n_removed", "kept_sha256") == want and any(row[2] for row in want)


def test_op7(spark, docs):
    items = [tuple(row) for row in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    exact = sorted((key, item) for key, text, _ in docs for item, passage in items if normal(passage) in normal(text))
    got = rows(spark, "op7_leaks", "doc_id", "item_id", "n_edits")
    assert [(key, item) for key, item, edits in got if edits == 0] == exact and exact


def test_op9(spark, docs):
    roots, links = brute.near([text for _, text, _ in docs])
    want = [(key, docs[root][0], n) for (key, _, _), root, n in zip(docs, roots, links)]
    assert rows(spark, "op9_near_copies", "doc_id", "class_id", "n_links") == want and any(links)


def test_op10(spark, docs):
    got = rows(spark, "op10_language_model", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    want = brute.unigram_scores([(key, text) for key, text, _ in docs])
    assert [row[1:5] for row in got] == [row[:4] for row in want]
    assert np.allclose([row[5] for row in got], [row[4] for row in want])
    held = [row for row in got if row[1]]
    assert sum(row[6] for row in held) > sum(row[5] for row in held)


def brute_pipeline(rows, items):
    """(doc_id, text) of what the stages before the last keep."""
    @functools.cache
    def grams(text, letters):
        hashes, first, letter = ngrams([text.encode()], letters)
        return hashes.tolist(), bool(letter[0])

    def filters(letters):
        counts: dict[str, Counter] = {}
        for key, text, lang in rows:
            if brute.crc(key) % 3 == 0 and text is not None and lang is not None and grams(text, letters)[1]:
                counts.setdefault(lang, Counter()).update(grams(text, letters)[0])
        return {lang: {gram for gram, n in count.items() if n >= COMMON * count.total()} for lang, count in counts.items()}

    def share(text, known, letters):
        found = grams(text, letters)[0]
        return sum(gram in known for gram in found) / len(found)

    models, least = {n: filters(n) for n in (4, 1)}, {}
    for n, known in models.items():
        for lang in known:
            own = sorted(share(text, known[lang], n) for key, text, of in rows if brute.crc(key) % 3 == 2 and of == lang and text and grams(text, n)[1])
            least[n, lang] = own[math.ceil(0.01 * len(own)) - 1] / 2 if own else 0
    kept = []
    for key, text, _ in rows:
        if text is None or not grams(text, 4)[1]:
            continue
        accepted = {
            n: {lang for lang in models[n] if share(text, models[n][lang], n) >= least[n, lang] - slack / math.sqrt(len(grams(text, n)[0]))}
            for n, slack in ((4, 1.5), (1, 0))
        }
        if accepted[4] & accepted[1]:
            kept.append((key, text))
    roots, _ = brute.near([text for _, text in kept])
    least = {}
    for row, root in zip(kept, roots):
        least[root] = min(least.get(root, row), row, key=lambda r: (r[0] is not None, r))
    kept = list(least.values())
    cut = []
    for (key, text), (words, gone) in zip(kept, brute.kept_words([text for _, text in kept])):
        cut.append((key, " ".join(word for i, word in enumerate(words) if i not in gone) if gone else text))
    passages = [normal(item) for item in items]
    return [(key, text) for key, text in cut if not any(passage in normal(text) for passage in passages)]


def test_pipeline(spark, docs):
    items = [row.text for row in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = sorted(bpe_digest(key, text) for key, text in brute_pipeline(docs, items))
    assert rows(spark, "pipeline", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert 0 < len(want) < len(docs)


def test_stages_of_strange_documents(spark):
    for given in (strange(spark, ("id", "_id", "kept", "score", "class_no", "n_words")), nothing(spark)):
        table = saved(given, "given")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before, table = table, saved(stage(spark, table, SMALL), name)
            assert table.columns == before.columns and dict(table.dtypes) == dict(before.dtypes)
        assert table.filter("n_chars <> length(text)").count() == 0
        keys = Counter(row.doc_id for row in table.collect())
        assert not given.columns[5:] or (keys[6] == 1 and keys[7] == keys[0] == 0 and keys[-5] == 1)
        last = corpus_pipeline.STAGES[-1][1](spark, table, SMALL)
        assert last.count() == table.count()


@pytest.mark.parametrize("n", [30, 1_500])
def test_short_texts_and_large_alphabets_stay_at_any_size(spark, n):
    draw = random.Random(n)
    signs = [chr(0x4E00 + i) for i in range(1_500)]
    rows = [(i, "".join(draw.choices(signs, k=120)), "zh") for i in range(n)]
    rows += [(n + i, "All rights reserved to the authors of this page " * 3, "en") for i in range(n)]
    rows += [(2 * n + i, text, "en") for i, text in enumerate(["A.", "to", "αβγ δεζ ηθι", "12 34", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    given = docs.withColumn("lang", F.when(F.col("doc_id") < 2 * n, F.col("lang")))
    kept = {row.doc_id for row in corpus_pipeline.keep_languages(spark, given, SMALL).collect()}
    assert kept == set(range(2 * n + 2))


@pytest.mark.parametrize("n", [60, 2_000])
def test_nonsense_in_known_letters_goes_at_any_size(spark, n):
    draw = random.Random(n)
    words = ["the", "house", "stands", "where", "river", "bends", "and", "people", "cross", "every", "morning", "with", "their", "children", "garden", "market"]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(2, 80))), "en") for i in range(n)]
    nonsense = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz  ", k=k)) for k in (120, 400, 5_000)]
    other = ["the garden", "go", "every river bends where people cross"]
    rows += [(n + i, text, None) for i, text in enumerate(nonsense + other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {row.doc_id for row in corpus_pipeline.keep_languages(spark, docs, SMALL).collect()}
    assert kept == {*range(n), *range(n + 3, n + 6)}
