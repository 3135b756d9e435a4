"""Secrets in texts: fixed patterns, and random strings by token efficiency (operator 11).

Prose takes few tokens for its characters, as the vocabulary was made of prose; a random
string takes many. Runs of the characters that keys are written with, outside of what the
patterns have found, are encoded with a tiktoken vocabulary; those with under two characters
a token (letters of one case: 1.75) are reported as `random`. Known digests and identifiers are as inefficient and no
secrets, so they are taken out first: hexadecimal digests of the usual lengths, digests that
name their function, embedded files, UUIDs, numbers, and names put together from words.

Everything is done on the bytes of a slice of texts at once: runs by array operations,
patterns at the places where one of their words stands. White space joins the texts, which
no pattern crosses."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolecast.llm.byte_bpe import read_ranks
from rolecast.llm.texts import raw, slices

KINDS = ("assign", "access", "hex", "random")
#: The base patterns, in small letters for assign, and the least lengths.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

#: A run of at least so many characters, with less than so many characters a token, is random.
LEAST_RUN, LEAST_EFFICIENCY = 20, 2.0
#: The same for a run of letters of one case, as a share of the above: compound words of
#: languages that the vocabulary knows little of take more tokens than other words.
ONE_CASE = 0.875
#: Hexadecimal digits of MD5, SHA-1, Tiger, and SHA-2 or SHA-3 with 224, 256, 384 and 512 bits.
DIGEST_DIGITS = (32, 40, 48, 56, 64, 96, 128)
DIGEST = re.compile(rb"(?:0x)?(?:%s)" % b"|".join(b"[0-9a-fA-F]{%d}" % n for n in DIGEST_DIGITS))
NAMED_DIGEST = re.compile(rb"(?i:md5|sha1|sha224|sha256|sha384|sha512)[-_=:/][A-Za-z0-9+/_=-]+")
DIGEST_BEFORE = re.compile(rb"(?i:(?:md5|sha-?(?:1|224|256|384|512))['\"]?\x20*[:=]\x20*['\"]?|base64,)\Z")
UUID = re.compile(rb"[{]?[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
NUMBER = re.compile(rb"[0-9+/_=-]+")
#: What a name is put together from: words of one case or with a capital first, numbers, signs.
NAME_PARTS = re.compile(rb"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+|[+/_=-]+")
LONGEST_WORD, MEAN_WORD = 15, 4


def _class(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX = _class(b"0123456789abcdef")
KEY = _class(_LETTERS + b"0123456789+/_=-")


def long_runs(data: np.ndarray, table: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Start and end of each longest run of characters of a class that is long enough."""
    inside = np.concatenate([[False], table[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    enough = ends - starts >= least
    return list(zip(starts[enough].tolist(), ends[enough].tolist()))


def assignments(lower: bytes) -> list[tuple[int, int]]:
    """All matches of ASSIGN from left to right, long enough ones only: a match starts where
    one of its words does, so only these places are tried."""
    places = set()
    for word in ASSIGN_WORDS:
        at = lower.find(word)
        while at >= 0:
            places.add(at)
            at = lower.find(word, at + 1)
    found, end = [], 0
    for place in sorted(places):
        match = ASSIGN.match(lower, place) if place >= end else None
        if match:
            end = match.end()
            if match.end(2) - match.start(2) >= LEAST_ASSIGN:
                found.append(match.span())
    return found


def outside(runs: list[tuple[int, int]], taken: list[tuple[int, int]], least: int) -> Iterator[tuple[int, int]]:
    """The parts of sorted runs that lie outside of sorted spans and are long enough."""
    i = 0
    for start, end in runs:
        while i and taken[i - 1][1] > start:
            i -= 1  # a span may reach into several runs
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        at, j = start, i
        while j < len(taken) and taken[j][0] < end:
            if taken[j][0] - at >= least:
                yield at, taken[j][0]
            at = max(at, taken[j][1])
            j += 1
        if end - at >= least:
            yield at, end


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans that do not overlap and cover the same."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((start, end))
    return found


def is_name(run: bytes) -> bool:
    """Whether a run is words put together: none too long, MEAN_WORD letters on average, and
    a number for every second word at most."""
    parts = NAME_PARTS.findall(run)
    words = [len(part) for part in parts if part.isalpha()]
    numbers = sum(part.isdigit() for part in parts)
    return bool(words) and max(words) <= LONGEST_WORD and sum(words) >= MEAN_WORD * len(words) and 2 * numbers <= len(words) + 1


def known(run: bytes, before: bytes) -> bool:
    """Whether a run is a digest, an embedded file or an identifier; `before` stands before it."""
    return bool(
        DIGEST.fullmatch(run) or NAMED_DIGEST.fullmatch(run) or UUID.fullmatch(run) or NUMBER.fullmatch(run)
        or DIGEST_BEFORE.search(before) or is_name(run)
    )


class Finder:
    """Finds secrets with one vocabulary."""

    def __init__(self, path: str, pattern: str, least_efficiency: float):
        import tiktoken

        self.encoding = tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
        self.least_efficiency = least_efficiency

    def spans(self, texts: list[bytes]) -> list[list[dict]]:
        """For each text its spans by start and then kind, in code points."""
        blob = b"\n".join([*texts, b""])
        data, lower = np.frombuffer(blob, np.uint8), blob.lower()
        base = [assignments(lower), [m.span() for m in ACCESS.finditer(blob) if m.end() - m.start() >= LEAST_ACCESS], long_runs(data, HEX, LEAST_HEX)]
        rows = [(start, kind, end, None) for kind, spans in enumerate(base) for start, end in spans]
        for start, end in outside(long_runs(data, KEY, LEAST_RUN), merged([span for spans in base for span in spans]), LEAST_RUN):
            run = blob[start:end]
            if not known(run, blob[max(0, start - 16) : start]):
                tokens = len(self.encoding.encode_ordinary(run.decode()))
                share = ONE_CASE if run.isalpha() and (run[1:].islower() or run.isupper()) else 1
                if end - start < self.least_efficiency * share * tokens:
                    rows.append((start, 3, end, tokens))
        found: list[list[dict]] = [[] for _ in texts]
        if rows:
            rows.sort(key=lambda row: row[:2])
            starts = np.concatenate([[0], np.cumsum([len(text) + 1 for text in texts])]).astype(np.int64)
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
            places = np.searchsorted(starts, [row[0] for row in rows], side="right") - 1
            for (start, kind, end, tokens), i in zip(rows, places.tolist()):
                first = points[starts[i]]
                found[i].append({"kind": KINDS[kind], "start": int(points[start] - first), "end": int(points[end] - first), "n_tokens": tokens})
        return found


_FINDERS: dict[tuple, Finder] = {}
SPANS = T.ArrayType(
    T.StructType([T.StructField(name, kind) for name, kind in (("kind", T.StringType()), ("start", T.LongType()), ("end", T.LongType()), ("n_tokens", T.LongType()))])
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("n_tokens", pa.int64())]))


def find_secrets(docs: DataFrame, path: str, pattern: str, least_efficiency: float = LEAST_EFFICIENCY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key` and spans, an array of (kind, start, end, n_tokens),
    by start and then in the order of KINDS.

    Starts and ends are code points, ends exclusive; an `assign` span is the whole
    assignment. Spans of different kinds may overlap, but a `random` one overlaps no other;
    it alone has a number of tokens. `path` is a .tiktoken file that every executor has.
    Null and empty texts have no spans; null keys stay null; repeated rows each get a row;
    very long texts are looked at whole, as a slice of their own; an empty table gives no
    rows; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _FINDERS.get(settings := (path, pattern, least_efficiency)) or _FINDERS.setdefault(settings, Finder(*settings))
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(finder.spans(raw(batch.column("text"))), _SPANS)], names=["key", "spans"])

    kind = docs.schema[key].dataType
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    found = rows.mapInArrow(run, T.StructType([T.StructField("key", kind), T.StructField("spans", SPANS)]))
    return found.select(F.col("key").alias(key), "spans")


def _written(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digests of the rows of find_secrets."""

    def number(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    digest = F.sha2(_written(base).cast("binary"), 256).alias("base_sha256")
    return found.select(key, *[number(kind) for kind in KINDS], digest, _written(F.col("spans")).alias("spans"))
