"""Secret scans: the base patterns against the contract's, random runs against a plain version."""

import hashlib
import random
import string

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
import brute
from rolecast.llm.byte_bpe import read_ranks
from rolecast.llm.secrets import KINDS, ONE_CASE, Finder, find_secrets, is_name, known, secret_digests
from strange import nothing, strange, strange_rows

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})
PIECE_FINDER = Finder(PATH, PATTERN, 2.0)
PIECES = [
    "password", "PASSWD", "Secret", "token", "api_key", "APIKEY", "apikey", "pass", "=", ":", " ", "  ", '"', "'", "abcdefgh", "x1", "é", "ſecret", "toKen", "\n", "😀",
    "AKIA", "AKIAAKIA", "ABCDEFGH0123", "deadbeef", "0123456789abcdef", "A", "zZ9+/", "qX7_kP2vL9wT4mR8sB3n", "550e8400-e29b-41d4-a716-446655440000", ".", "-", "word",
]


@pytest.fixture(scope="module")
def finder():
    return Finder(PATH, PATTERN, 2.0)


def plain(text):
    text = text or ""
    base = brute.base_secrets(text)
    found = [(start, kind, end) for start, kind, end in base]
    for start, end in brute.random_runs(text, base):
        run, n = text[start:end], len(LIBRARY.encode_ordinary(text[start:end]))
        share = ONE_CASE if run.isalpha() and (run[1:].islower() or run.isupper()) else 1
        if not known(run.encode(), text.encode()[max(0, len(text[:start].encode()) - 16) : len(text[:start].encode())]) and end - start < 2 * share * n:
            found.append((start, 3, end))
    return sorted(found)


def spans(found):
    return [(span["start"], KINDS.index(span["kind"]), span["end"]) for span in found]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=1, max_size=4))
def test_pieces(texts):
    assert [spans(found) for found in PIECE_FINDER.spans([text.encode() for text in texts])] == [plain(text) for text in texts]


@pytest.mark.parametrize("text, kinds", [
    ("token=token=abcdefgh", ["assign"]), ("password=secret: abcdefgh", []), ("password = short", []), ("passwordpassword: 'longenough1'", ["assign"]),
    ("AKIAAKIA0123456789", ["access"]), ("AKIA0123", []), ("a" * 32, ["hex"]), ("ab" * 15 + "a", []), ("ſecret=abcdefgh", []),
    ("my_password=abcdefgh", ["assign"]), ("API_KEY:abcdefgh and apikey='ABCDEFGH'", ["assign", "assign"]), ("password=" + "0" * 40, ["assign", "hex"]),
])
def test_base(finder, text, kinds):
    (found,) = finder.spans([text.encode()])
    assert [span["kind"] for span in found if span["kind"] != "random"] == kinds and spans(found) == plain(text)


@pytest.mark.parametrize("run", [
    "d41d8cd98f00b204e9800998ecf8427e", "DA39A3EE5E6B4B0D3255BFEF95601890AFD80709", "550e8400-e29b-41d4-a716-446655440000", "4028005252517056123456",
    "sha512-z4PhNX7vuL3xVChQ1m2AB9Yg5AULVxXcg/SpIdNs6c5H0NE8XYXysP+DGNKHfuwvY7kxvUdBeoGlODJ6+SfaPg==", "snake_case_identifier_name_v2",
    "getElementsByClassNameAndTagNameOrId", "https/path/to/some/file_name", "SCREAMING_SNAKE_CASE_NAME", "2024-12-01-some-long-slug-title",
])
def test_known_runs_are_left_alone(finder, run):
    (found,) = finder.spans([f"see {run} there".encode()])
    assert all(span["kind"] == "hex" for span in found)  # a base pattern stays


def test_digests_by_what_stands_before(finder):
    run = "z4PhNX7vuL3xVChQ1m2AB9Yg5AULVxXcg"
    texts = [f"sha256: {run}", f"data:image/png;base64,{run}", f"key {run}"]
    assert [len(found) for found in finder.spans([text.encode() for text in texts])] == [0, 0, 1]


def test_random_strings_are_found_and_prose_is_not(finder):
    draw = random.Random(3)
    for letters in (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_lowercase + string.digits):
        texts = [f"use {''.join(draw.choices(letters, k=32))} here".encode() for _ in range(300)]
        assert sum(any(span["kind"] == "random" for span in found) for found in finder.spans(texts)) >= 295
    words = [b" ".join(draw.choices([b"international", b"organisation", b"of", b"the", b"Rechtsschutzversicherungsgesellschaft"], k=50)) for _ in range(50)]
    assert finder.spans(words) == [[] for _ in words]


def test_names_take_linear_time():
    assert not is_name(b"A" * 200_000 + b"1b+" * 50_000) and not known(b"Ab1" * 100_000, b"")


def test_query(spark):
    docs = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{entry.SMALL}/documents.parquet").collect()}
    got = entry.queries()["op11_secrets"](spark, entry.SMALL).collect()
    assert len(got) == len(docs)
    for row in got:
        found = plain(docs[row["doc_id"]])
        written = [f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found]
        base = ",".join(text for text in written if not text.startswith("random"))
        counts = [sum(kind == k for _, kind, _ in found) for k in range(4)]
        assert [row["n_assign"], row["n_access"], row["n_hex"], row["n_random"]] == counts
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and row["spans"] == ",".join(written)


def test_strange_documents(spark):
    extra = [(20, "password=abcdefgh " * 20_000, "en", "s", 1), (21, "qX7kP2vL9wT4mR8sB3n+" * 5_000, "en", "s", 1)]
    df = strange(spark, ("spans", "kind", "start", "n_tokens", "n_hex", "base_sha256")).unionByName(
        spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True
    )
    got = sorted(((row["doc_id"], spans(row["spans"])) for row in find_secrets(df, PATH, PATTERN).collect()), key=str)
    assert got == sorted(((row[0], plain(row[1])) for row in [*strange_rows(), *extra]), key=str)
    digests = secret_digests(find_secrets(df, PATH, PATTERN))
    assert digests.columns == ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]
    assert digests.where(F.col("doc_id") == 1).select("base_sha256", "spans").first() == (hashlib.sha256(b"").hexdigest(), "")
    assert find_secrets(nothing(spark), PATH, PATTERN).collect() == []
