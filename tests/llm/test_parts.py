"""Parts of operators without Spark, against brute force."""

import base64
from collections import Counter
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from rolecast.llm import language_model
from rolecast.llm.byte_bpe import Bpe, read_ranks
from rolecast.llm.fm_index import WaveletMatrix, WordIndex
from rolecast.llm.languages import LanguageModel, ngrams, slots_of
from rolecast.llm.leaks import Items, budget, fewest_edits, normal, points_of
from rolecast.llm.near_copies import intersections, shingles, signatures
from rolecast.llm.perfect_hash import PerfectHash
from rolecast.llm.quality import Forest, repeat_words, usual_path
from rolecast.llm.seating import draw_tables, table_weights
from rolecast.llm.texts import Words, unused, window_hashes
from rolecast.llm.token_counts import counter, drops_spaces
from rolecast.llm.token_files import NULL, Shard, key_hashes, pack

words_of = st.lists(st.sampled_from([b"a", b"b", b"cc", "é".encode(), b""]), max_size=12)


@given(st.lists(st.text("ab \n\t é", max_size=30), max_size=6))
def test_words(texts):
    data = [text.encode() for text in texts]
    words = Words(data)
    got = [[words.data[words.starts[i] : words.ends[i]].tobytes() for i in range(a, b)] for a, b in zip(words.first, words.first[1:])]
    assert got == [text.split() for text in data]
    flat = [word for text in data for word in text.split()]
    assert [len({h for h, w in zip(words.hashes().tolist(), flat) if w == word}) for word in set(flat)] == [1] * len(set(flat))
    starts, _ = window_hashes(words.hashes(), words.first, 2)
    assert len(starts) == sum(max(0, len(text.split()) - 1) for text in data)


def test_unused_names():
    assert unused(["a", "ID", "_id"], "id") == "__id"


@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
@settings(deadline=None)
def test_perfect_hash_is_minimal(keys):
    hashes = np.array(sorted(keys), np.uint64)
    index = PerfectHash.build(hashes)
    assert sorted(index.slots(hashes).tolist()) == list(range(len(hashes)))
    again = PerfectHash.load(index.sizes, index.bits)
    assert (again.slots(hashes) == index.slots(hashes)).all()


def test_shard_file_round_trip():
    keys = [None, b"", b"5", b"5", b"77"]
    ids = [[1], [], [2, 3], [4], [65535] * 9]
    shard = Shard(pack(keys, [np.array(row, "<u2").tobytes() for row in ids], 2))
    assert shard.keys() == keys and [shard.ids_of(i).tolist() for i in range(5)] == ids
    assert shard.rows_of(keys).tolist() == [0, 1, 2, 2, 4]
    assert (shard.rows_of([b"no", b"6", b"\x00"]) == -1).all()
    assert Shard(pack([], [], 2)).rows_of([b"x"]).tolist() == [-1]
    with pytest.raises(ValueError):
        pack([b"1", b"2", b"1"], [b"", b"", b""], 2)
    assert len(set(key_hashes([None, b"", b"\x00", b"\x01"]).tolist())) == 4 and NULL == 2**32 - 1


@given(st.lists(st.integers(0, 9), max_size=200), st.integers(0, 9))
def test_wavelet_rank(symbols, symbol):
    matrix = WaveletMatrix(np.array(symbols, np.int64), 9)
    places = np.arange(len(symbols) + 1)
    assert matrix.rank(np.full(len(places), symbol), places).tolist() == [symbols[:i].count(symbol) for i in places]


@pytest.mark.parametrize("seed", range(8))
def test_repeated_windows(seed):
    draw = random.Random(seed)
    width = draw.choice([3, 5, 35])
    vocabulary = [b"w%d" % i for i in range(draw.choice([1, 3, 200]))]
    base = draw.choices(vocabulary, k=200)
    fragments = []
    for _ in range(40):
        start, size = draw.randrange(200 - 2 * width), draw.randint(1, 2 * width)
        fragments.append(base[start : start + size] if draw.random() < 0.7 else draw.choices(vocabulary, k=size))
    weights = np.array([draw.choice([1, 1, 2]) for _ in fragments])
    counts = Counter()
    for words, weight in zip(fragments, weights):
        for i in range(len(words) - width + 1):
            counts[tuple(words[i : i + width])] += weight
    want = {(f, i) for f, words in enumerate(fragments) for i in range(len(words) - width + 1) if counts[tuple(words[i : i + width])] > 1}
    fragment, start = WordIndex(fragments, weights, width).repeated()
    assert set(zip(fragment.tolist(), start.tolist())) == want


@given(st.text("abc", min_size=1, max_size=10), st.text("abc", max_size=20))
def test_banded_alignment(item, text):
    row = [0] * (len(text) + 1)
    for i, char in enumerate(item):
        new = [i + 1]
        for j, other in enumerate(text):
            new.append(min(row[j] + (char != other), row[j + 1] + 1, new[-1] + 1))
        row = new
    edits, end = fewest_edits(points_of(item), points_of(text), -len(item), len(text))
    assert edits == min(row) and 0 <= end <= len(text)


def whole_search(items, docs):
    found = {}
    for d, doc in enumerate(docs):
        text = normal(doc)
        for i, item in enumerate(items):
            pattern, row = normal(item), None
            if len(pattern) < 8:
                continue
            row = [0] * (len(text) + 1)
            for k, char in enumerate(pattern):
                new = [k + 1]
                for j, other in enumerate(text):
                    new.append(min(row[j] + (char != other), row[j + 1] + 1, new[-1] + 1))
                row = new
            if min(row) <= budget(len(pattern)):
                found[d, i] = min(row)
    return found


@pytest.mark.parametrize("seed", range(3))
def test_leak_search_is_complete(seed):
    draw = random.Random(seed)
    letters = "abcdef gh"
    items = ["".join(draw.choices(letters, k=draw.randint(8, 90))) for _ in range(15)] + ["ab ab ab ab ab ab ab ab"]
    docs = []
    for _ in range(40):
        chars = list(draw.choice(items))
        for _ in range(draw.randint(0, 10)):
            i = draw.randrange(len(chars))
            chars[i : i + draw.randint(0, 1)] = draw.choices(letters, k=draw.randint(0, 1))
            chars = chars or ["a"]
        docs.append("".join(draw.choices(letters, k=draw.randint(0, 30))) + "".join(chars) + draw.choice(["", "\n", " zz"]))
    docs += ["", "ab " * 60]
    kept = [item for item in items if len(normal(item)) >= 8]
    got = {(d, i): edits for d, i, edits, _ in Items.build(list(range(len(kept))), kept).search(docs)}
    assert got == whole_search(kept, docs)


def test_intersections():
    draw = random.Random(5)
    sets = [np.array(sorted(draw.sample(range(60), draw.randint(0, 50))), np.uint64) for _ in range(40)]
    common = intersections(sets)
    for a in range(40):
        for b in range(a + 1, 40):
            assert common[a, b] == len(np.intersect1d(sets[a], sets[b]))


def test_min_hashes_estimate_similarity():
    words = [b"w%d" % i for i in range(400)]
    found, first = shingles([b" ".join(words), b" ".join(words[:360]), b"", b"one two"])
    assert np.diff(first).tolist() == [396, 356, 0, 1]
    signed = signatures(found, first)
    assert abs((signed[0] == signed[1]).mean() - 356 / 396) < 0.08 and len(signed) == 3


def test_language_filters():
    texts = [b"the thing", b"", b"a", b"1 2", "éé".encode()]
    hashes, first, letter = ngrams(texts)
    assert np.diff(first).tolist() == [8, 1, 1, 1, 1] and letter.tolist() == [True, False, True, False, True]
    table = np.zeros((1 << 12, 1), np.uint64)
    for row in slots_of(hashes[first[0] : first[1]], 1 << 12):
        np.bitwise_or.at(table[:, 0], row, np.uint64(2))
    named, scores = LanguageModel(["de", "en"], table).predict(texts)
    assert named == ["en", "und", "de", "und", "de"] and scores[0] > 0.99 and (scores[1:] < 0.01).all()
    assert LanguageModel([], table).predict([b"word"])[0] == ["und"]


def test_many_languages_share_a_table():
    names = [f"l{i:03}" for i in range(130)]
    table = np.zeros((1 << 12, 3), np.uint64)
    hashes, _, _ = ngrams([b"hello"])
    for row in slots_of(hashes, 1 << 12):
        np.bitwise_or.at(table[:, 2], row, np.uint64(1 << (128 - 126)))
    assert LanguageModel(names, table).predict([b"hello"])[0] == ["l128"]


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=25))
def test_repeat_words(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, window in enumerate(windows) if windows.count(window) > 1 for j in range(3)}
    assert repeat_words(words) == len(covered)


def test_forest_finds_what_is_far():
    draw = np.random.default_rng(0)
    clean = np.abs(draw.normal(0, 0.02, (500, 5))).clip(0, 1)
    forest = Forest.fit(clean)
    odd = clean[:5].copy()
    odd[:, 2] = 0.9
    assert forest.scores(odd).min() > forest.scores(clean).max()
    assert usual_path(1) == 0 and usual_path(2) == 1 and Forest.fit(clean[:1]).scores(clean).shape == (500,)


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def bpe():
    return Bpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


@settings(max_examples=60, deadline=None)
@given(st.text() | st.lists(st.sampled_from(["the", " ", "\n", "  ", "'s", "'ll", "é", "12", "!?", "\t", "\x1c", " ", "漢", "ation"])).map("".join))
def test_byte_bpe(bpe, library, text):
    ((ids, decoded),) = bpe.encode([text.encode()])
    assert ids.decode() == " ".join(map(str, library.encode_ordinary(text))) and decoded == text.encode()


def test_byte_bpe_of_long_matches(bpe, library):
    draw = random.Random(1)
    for text in ("a" * 4_000, "ab" * 1_500, "".join(draw.choices("etaoinshr", k=3_000)), "=" * 1_500):
        ((ids, decoded),) = bpe.encode([text.encode()])
        assert ids.decode() == " ".join(map(str, library.encode_ordinary(text))) and decoded == text.encode()
    assert read_ranks(RANKS)[base64.b64decode("IQ==")] == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_agree_with_the_library(name):
    path = public_tokenizers.path(name)
    texts = ["", " ", "The THE the", "a b", "ΑΣ Σ", "x<|endoftext|>y <|ENDOFTEXT|>", "é ́", "don't  stop\n\nnow", "漢字 İ 😀", "of " * 50]
    if name.endswith(".model"):
        import sentencepiece

        want = [len(ids) for ids in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    else:
        from tokenizers import Tokenizer

        want = [len(item.ids) for item in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert counter(path)([text.encode() for text in texts]) == want
    assert name.endswith(".model") or drops_spaces(path) == name.startswith("word")


def test_table_draws():
    weights = table_weights(0.5)
    assert np.allclose(weights[2][1:] / weights[2][2], [0.5, 1])  # two customers: one table, or two
    assert np.allclose(weights[3][1:] / weights[3][3], [0.75, 1.5, 1])
    draw = np.random.default_rng(0)
    customers = np.array([0, 1, 2, 50, 100_000] * 2_000)
    tables = draw_tables(customers, np.full(len(customers), 0.5), 0.5, draw)
    assert (tables <= customers).all() and (tables[customers > 0] >= 1).all()
    two = tables[customers == 2]
    assert abs((two == 2).mean() - 0.5) < 0.05


def test_usual_words_are_named_by_place():
    draw = np.random.default_rng(3)
    words = np.sort(draw.integers(0, 1 << 64, 3000, dtype=np.uint64))
    usual = np.append(words[: 2 : -3], words[1::3])
    usual.sort()
    columns = [words[draw.integers(0, len(words), 9000)] for _ in range(3)]
    sizes = []
    for known in (language_model.NONE, usual, words, words[:1], words[-1:]):
        cells = {name: language_model.packed(values) for name, values in language_model.spelled(columns, known).items()}
        assert all((a == b).all() for a, b in zip(columns, language_model.read(cells, 3, known), strict=True))
        sizes.append(len(cells["a"]) + len(cells["e"]))
    assert sizes[2] < sizes[1] < sizes[0] / 2


def test_places_in_order_where_leading_bits_are_equal():
    values = np.array([5, 3, 1 << 63, 4, 3, (1 << 63) + 1, 0], np.uint64)
    order, found = language_model.in_order(values)
    assert found.tolist() == sorted(values.tolist()) and (values[order] == found).all()
    first, which = language_model.distinct(values)
    assert (values[first][which] == values).all() and len(first) == 6
    assert all(len(found) == 0 for found in language_model.distinct(values[:0]))
