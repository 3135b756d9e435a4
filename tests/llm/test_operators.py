"""Operators on strange tables, empty tables and random documents, against plain versions."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from rolecast.llm import language_model, languages, near_copies, repeats, token_files
from rolecast.llm.byte_bpe import encoded_digests, read_ranks
from rolecast.llm.language_model import document_scores
from rolecast.llm.leaks import find_leaks
from rolecast.llm.quality import COUNTS, document_quality
from rolecast.llm.shards import document_shards, permuted, shuffle_into_shards
from rolecast.llm.token_counts import token_counts
from rolecast.session import new_path, saved
from strange import nothing, random_docs, strange, strange_rows

WORDS, RANKS = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def odd(spark):
    return saved(strange(spark), "strange")


@pytest.fixture(scope="module")
def mixed(spark):
    return saved(random_docs(spark), "mixed")


def listed(df, *columns):
    chosen = [tuple(row) for row in df.select(*columns).collect()] if columns else [tuple(row) for row in df.collect()]
    return sorted(chosen, key=lambda row: tuple((value is None, str(value)) for value in row))


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


TEXTS = [(key, text) for key, text, *_ in strange_rows()]


# sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 250])
def test_permutation(spark, n):
    places = [row[0] for row in spark.range(n).select(permuted(F.col("id"), n, 7)).collect()]
    assert sorted(places) == list(range(n))
    assert n < 16 or places != list(range(n))


def test_shards(odd):
    got = document_shards(odd, 3).collect()
    assert ordered((r.doc_id, r.size, r.text_crc32) for r in got) == ordered((k, 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for k, t in TEXTS)
    for shard in range(3):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots))) and abs(len(slots) - len(got) / 3) < 1
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert listed(document_shards(odd.repartition(5), 3)) == listed(document_shards(odd, 3))


def test_shards_keep_columns(spark, odd):
    got = shuffle_into_shards(odd, 4, ["doc_id", "text"])
    assert sorted(got.columns) == sorted(odd.columns) and got.count() == odd.count()
    assert document_shards(nothing(spark), 4).count() == 0


# languages


def test_languages(spark, odd):
    got = {r.doc_id: r for r in languages.document_languages(odd).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[5].lang_pred == "und" and got[0].score == 0
    assert got[9].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (brute.crc(key) % 3 == 1) for key, r in got.items())
    empty = languages.document_languages(nothing(spark))
    assert empty.count() == 0 and empty.columns == ["doc_id", "held_out", "lang_pred", "score"]


def test_languages_without_labels(odd):
    model = languages.learn(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in languages.predict_languages(odd, model).collect()} == {"und"}


def test_languages_learn_from_labels_only(odd):
    model = languages.learn(odd)
    got = languages.predict_languages(odd.drop("lang", "source"), model)
    assert {r.doc_id: r.lang_pred for r in got.collect()}[13] == "de" and dict(got.dtypes)["score"] == "double"


# quality


def test_quality(spark, odd):
    labels = spark.createDataFrame([(9, 1), (10, 1), (-5, 1), (14, 0), (None, 1), (6, None), (9, 1)], "doc_id long, quality int")
    got = document_quality(odd, labels)
    names = [*COUNTS[:5], "base_failed"]
    assert listed(got, "doc_id", *names) == ordered((key, *brute.base_quality(text)) for key, text in TEXTS)
    assert got.filter("kept and base_failed").count() == 0 and got.filter("anomaly < 0 or anomaly > 1").count() == 0
    assert document_quality(nothing(spark), labels).count() == 0


def test_quality_without_labels_keeps_what_passes(spark, odd):
    got = document_quality(odd, spark.createDataFrame([], "doc_id long, quality int"))
    assert got.filter("kept = base_failed").count() == 0


def test_quality_rejects_marked_texts(spark, mixed):
    bad = mixed.limit(0).unionByName(mixed.withColumn("text", F.regexp_replace(F.upper("text"), " ", "!! # ")).withColumn("doc_id", F.col("doc_id") + 1000))
    both = saved(mixed.unionByName(bad), "both")
    labels = both.select("doc_id", (F.col("doc_id") < 1000).cast("int").alias("quality"))
    got = document_quality(both, labels).filter("not base_failed").groupBy((F.col("doc_id") < 1000).alias("clean"), "kept").count().collect()
    assert {(r.clean, r.kept) for r in got} == {(True, True), (False, False)}


# token files, counts, byte-level BPE


def test_token_files(spark, odd):
    tokenizer = Tokenizer.from_file(WORDS)
    want, start = {}, 0
    got = sorted(token_files.token_digests(odd, WORDS, 2).collect(), key=lambda r: r.start)
    texts = {}
    for key, text in TEXTS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        texts.setdefault(key, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == start
        start += r.n_tokens
        want.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert [r.doc_id is None for r in got][:2] == [True, True]
    keys = [r.doc_id for r in got][2:]
    assert keys == sorted(keys) and {k: sorted(v) for k, v in want.items()} == {k: sorted(v) for k, v in texts.items()}


def test_token_files_of_nothing(spark):
    got = token_files.token_digests(nothing(spark), WORDS, 2)
    assert got.count() == 0 and got.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_keyed_reads(spark, odd, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 20_000)
    folder = new_path(spark, "tokens")
    manifest = token_files.write_token_files(odd, WORDS, folder, 2)
    assert manifest.count() > 1
    found = token_files.read_by_key(spark, folder, ["6", "4", None, "nobody"]).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    want = [[*tokenizer.encode(text or "", add_special_tokens=False).ids, 2] for key, text in TEXTS if key in (6, 4, None)]
    assert sorted(r.ids for r in found) == sorted(want)


def test_token_counts(spark, odd):
    tokenizer = Tokenizer.from_file(WORDS)
    want = []
    for key, text in TEXTS:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        want.append((key, len((text or "").encode()), n, n > 100))
    assert listed(token_counts(odd, WORDS, 100)) == ordered(want)
    assert token_counts(nothing(spark), WORDS).count() == 0


def test_byte_level(spark, odd):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    want = []
    for key, text in TEXTS:
        ids = library.encode_ordinary(text or "")
        want.append((key, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert listed(encoded_digests(odd, RANKS, public_tokenizers.PATTERN)) == ordered(want)
    assert encoded_digests(nothing(spark), RANKS, public_tokenizers.PATTERN).count() == 0


# repeated passages


@pytest.mark.parametrize("hot", [1, 10_000])
def test_repeats(odd, mixed, hot):
    for docs in (odd, mixed):
        rows = docs.select("doc_id", "text").collect()
        got = repeats.remove_repeats(docs, hot=hot)
        want = [(row.doc_id, *result) for row, result in zip(rows, brute.repeats([row.text for row in rows]))]
        assert listed(got, "doc_id", "n_words", "n_removed", "kept_sha256") == ordered(want)
        assert got.filter("n_removed = 0 and not kept_text <=> text").count() == 0
        assert sorted(got.columns) == sorted({*docs.columns, "n_words", "n_removed", "kept_sha256", "kept_text"})


def test_repeats_of_short_windows(mixed):
    rows = mixed.select("doc_id", "text").collect()
    got = repeats.remove_repeats(mixed, width=6, anchor=3)
    assert listed(got, "doc_id", "n_words", "n_removed", "kept_sha256") == ordered((r.doc_id, *x) for r, x in zip(rows, brute.repeats([r.text for r in rows], 6)))


def test_repeats_of_nothing(spark):
    assert repeats.document_repeats(nothing(spark)).count() == 0


def test_texts_stay_in_their_buckets(mixed):
    """The texts are not moved again when what was found is joined to them."""
    texts = repeats.distinct_texts(mixed)
    spark = mixed.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = texts.join(texts.select("id").distinct(), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in plan


# near copies


@pytest.mark.parametrize("chunk", [2, 1_000])
def test_near_copies(odd, mixed, chunk):
    for docs in (odd, mixed):
        rows = docs.select("doc_id", "text").collect()
        roots, links = brute.near([row.text for row in rows])
        least = {}
        for row, root in zip(rows, roots):
            least[root] = min((key for key in (least.get(root), row.doc_id) if key is not None), default=None)
        got = near_copies.near_copies(docs, chunk_texts=chunk)
        assert listed(got, "doc_id", "class_id", "n_links") == ordered((row.doc_id, least[root], n) for row, root, n in zip(rows, roots, links))
        assert got.select("class_no").distinct().count() == len(set(roots))


def test_near_copies_shorten_prefixes(mixed, monkeypatch):
    depths = []
    compare = near_copies.verified_links
    monkeypatch.setattr(near_copies, "verified_links", lambda texts, members, depth: depths.append(depth) or compare(texts, members, depth))
    near_copies.near_copies(mixed, recall=1.0).count()
    assert depths == list(range(near_copies.DEPTH, depths[-1] - 1, -1)) and depths[-1] < 4


def test_near_copies_of_nothing(spark):
    assert near_copies.document_near_copies(nothing(spark)).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.range(1, 60).select(F.col("id").alias("number"), (F.col("id") - 1).alias("root"))
    two = edges.unionByName(spark.createDataFrame([(101, 100), (102, 101)], "number long, root long"))
    assert listed(near_copies.components(two).groupBy("class").count()) == [(0, 60), (100, 3)]


# benchmark passages


def test_leaks(spark, odd):
    passage = strange_rows()[-1][1][40:200]
    items = spark.createDataFrame([(1, passage), (1, passage), (2, None), (3, ""), (4, "short"), (5, passage.upper().replace(" ", "\n")), (6, "zq" * 40)], "item_id long, text string")
    assert listed(find_leaks(odd, items), "doc_id", "item_id", "n_edits") == [(-5, 1, 0), (-5, 5, 0)]
    changed = odd.withColumn("text", F.regexp_replace("text", F.lit(passage[50:58]), F.lit("XY")))
    got = listed(find_leaks(changed, items), "doc_id", "item_id")
    assert got == [(-5, 1), (-5, 5)]
    for docs, given in ((nothing(spark), items), (odd, items.limit(0))):
        assert find_leaks(docs, given).count() == 0


def test_leaks_in_blocks(spark, odd, monkeypatch):
    from rolecast.llm import leaks

    monkeypatch.setattr(leaks, "BLOCK_CHARS", 200)
    texts = [row[1][10:130] for row in strange_rows()[-1:]] + [f"nothing of this kind occurs anywhere number {i}" for i in range(20)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    assert listed(find_leaks(odd, items), "doc_id", "item_id") == [(-5, 0)]


# language model


def test_language_model(spark, odd, mixed):
    for docs in (odd, mixed):
        rows = [tuple(row) for row in docs.select("doc_id", "text").collect()]
        got = listed(document_scores(docs))
        want = ordered((key, held, n, known, total) for (key, _), (held, n, known, total, _) in zip(rows, brute.unigram_scores(rows)))
        assert ordered(row[:5] for row in got) == want
        sums = sorted(round(row[5], 6) for row in got)
        assert np.allclose(sums, sorted(base for *_, base in brute.unigram_scores(rows)), atol=1e-6)
        assert all(row[6] <= 0 for row in got)
    assert document_scores(nothing(spark)).count() == 0


def test_language_model_is_repeatable(mixed):
    assert listed(document_scores(mixed)) == listed(document_scores(mixed))


def test_language_model_without_training(odd):
    got = document_scores(odd.filter("doc_id = 0"), parts=1, part=0).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(True, 1, 0, 0, 0.0, 0.0)]


def test_language_model_tells_whole_words_before_apart(spark):
    held = [i for i in range(2_000) if brute.crc(i) % 7 == 2][:4]
    asked = ["the cat", "the dog", "we see the red sun", "we hear the red sun"]
    train = [i for i in range(1_000) if brute.crc(i) % 7 != 2]
    texts = ["the cat", "he dog", "we see the red sun", "we hear he blue sun"]  # 'the' and 'he' end alike
    rows = [(key, texts[i % 4]) for i, key in enumerate(train)] + list(zip(held, asked))
    got = {row.doc_id: row.score for row in document_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    cat, dog, see, hear = (got[key] for key in held)
    assert cat > dog + 1.5 and see > hear + 1


@pytest.mark.parametrize("hot", [1e-9, 1e9])
def test_language_model_chances_add_up(spark, mixed, hot, monkeypatch):
    """Over the known words and an unknown one, with hot words before spread and whole."""
    monkeypatch.setattr(language_model, "HOT", hot)
    train = [row.text for row in mixed.collect()]
    known = sorted({word for text in train for word in text.lower().split()})
    before = train[0].lower().split()[0]
    rows = [(i, False, text) for i, text in enumerate(train)]
    rows += [(-1 - i, True, f"{before} {word}") for i, word in enumerate(["", *known, "unheard"])]
    docs = spark.createDataFrame(rows, "key long, held_out boolean, text string").coalesce(1)
    asked = language_model.ask(docs, [3, 3, 3])
    model = language_model.Model(asked, [3, 3, 3])
    for sweep in range(language_model.SWEEPS):
        model.tell(last=False)
        model.sweep(sweep)
    model.tell(last=True)
    (part,) = asked.rows(language_model.PART).collect()
    answers = sorted(row for table in model.answers() for row in table.rows(language_model.DOWN).select("peer", "a").collect())
    scores = np.concatenate([language_model.unpacked(bytes(row.a), "<f4") for row in answers])
    lengths, tokens = (language_model.unpacked(bytes(cell), "<i4") for cell in (part.a, part.b))
    second = (np.cumsum(lengths) - lengths + 1)[np.array(part.held_out)]
    assert abs((10.0 ** scores[tokens[second]]).sum() - 1) < 1e-4
    assert (len(model.learned.totals[1]) > 0) == (hot < 1)


@pytest.mark.parametrize("share, size", [(2.0, 64_000_000), (1e-2, 64_000_000), (1e-2, 200)])
def test_language_model_is_the_same_whatever_words_are_usual(mixed, monkeypatch, share, size):
    expected = sorted(map(tuple, document_scores(mixed).collect()), key=str)
    monkeypatch.setattr(language_model, "USUAL", share)
    monkeypatch.setattr(language_model, "USUAL_BYTES", size)
    assert sorted(map(tuple, document_scores(mixed).collect()), key=str) == expected
