"""Byte-level BPE by DuckDB queries inside Spark tasks (operator 5).

A recursive query holds one row per token of each distinct match: its spot (match and byte
position), the next spot and its id. A step joins each row to its neighbour and to the merge table, takes
the least rank of a match (the leftmost, if it occurs twice) and contracts that pair; a
match without a pair leaves the recursion. A second query decodes by an ordered aggregation
over the ids. Texts are put together from their matches."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rolecast.llm.texts import raw, slices

#: Pieces of text a worker remembers, in two halves: when one is full, the older goes.
REMEMBERED_PIECES = 500_000
#: A longer match (bytes) is contracted by a heap, as a recursion step costs time in
#: proportion to the match and there are as many steps as merges.
LONG_MATCH = 1_000

#: A token's spot is its match and, in the lower bits, its byte position.
PLACE_BITS = 10

ENCODE = f"""
with recursive state(spot, following, id, step) as (
    select spot, spot + 1, id, 0 from bytes
    union all
    select s.spot, if(s.spot = b.spot, b.after, s.following), if(s.spot = b.spot, b.id::int, s.id), s.step + 1
    from state s join (
        select x.spot >> {PLACE_BITS} as match,
               min(m.id << 40 | x.spot) & {(1 << 40) - 1} as spot,
               min(m.id << 40 | x.spot) >> 40 as id,
               arg_min(y.spot, m.id << 40 | x.spot) as gone,
               arg_min(y.following, m.id << 40 | x.spot) as after
        from state x
        join state y on y.spot = x.following
        join merges m on m.pair = (x.id::bigint << 32 | y.id)
        group by 1
    ) b on b.match = s.spot >> {PLACE_BITS}
    where s.spot <> b.gone
),
ended as (  -- the first token of a match is never contracted away
    select spot >> {PLACE_BITS} as match, max(step) as step from state where spot & {(1 << PLACE_BITS) - 1} = 0 group by 1
)
select spot >> {PLACE_BITS} as match, spot & {(1 << PLACE_BITS) - 1} as place, id::bigint as id
from state s join ended e on e.match = s.spot >> {PLACE_BITS} and e.step = s.step
"""

DECODE = """
select match, string_agg(spelled, ' ' order by place) as ids, unhex(string_agg(hexes, '' order by place)) as bytes
from tokens join vocabulary using (id) group by match order by match
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a .tiktoken file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Bpe:
    """Encoder and decoder of one vocabulary, in an in-process database of one thread."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([value])] for value in range(256)], np.int64)
        self.known: dict[bytes, bytes] = {}  # piece of text -> decimal ids
        self.older: dict[bytes, bytes] = {}  # the half of the memory before
        self.differs: dict[bytes, bytes] = {}  # piece -> decoded bytes, where these are not the piece
        splits = [
            (self.ranks[token[:i]] << 32 | self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        self._load("merges", pair=[pair for pair, _ in splits], id=[rank for _, rank in splits])
        self._load("vocabulary", id=list(self.ranks.values()), spelled=list(map(str, self.ranks.values())), hexes=[token.hex() for token in self.ranks])

    def _load(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create table {name} as select * from given")
        self.db.unregister("given")

    def matches(self, found: list[bytes]) -> list[tuple[bytes, bytes]]:
        """(ids as decimal text, decoded bytes) of each match."""
        if not found:
            return []
        short = [i for i, match in enumerate(found) if len(match) <= LONG_MATCH]
        sizes = np.array([len(found[i]) for i in short], np.int64)
        data = np.frombuffer(b"".join(found[i] for i in short), np.uint8)
        at = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        spot = np.repeat(np.array(short, np.int64), sizes) << PLACE_BITS | at
        rows = pa.table({"spot": spot, "id": self.byte_ids[data].astype(np.int32)})
        self.db.register("bytes", rows)
        tokens = self.db.sql(ENCODE).to_arrow_table()
        long = [(i, at, rank) for i, match in enumerate(found) if len(match) > LONG_MATCH for at, rank in enumerate(self.contract(match))]
        if long:
            tokens = pa.concat_tables([tokens, pa.table([pa.array(c, kind) for c, kind in zip(zip(*long), tokens.schema.types)], tokens.schema.names)])
        self.db.register("tokens", tokens)
        done = self.db.sql(DECODE).to_arrow_table()
        return list(zip(done["ids"].cast(pa.binary()).to_pylist(), done["bytes"].to_pylist()))

    def contract(self, match: bytes) -> list[int]:
        """The same contractions for one long match."""
        ids = [int(self.byte_ids[value]) for value in match]
        parts = [match[i : i + 1] for i in range(len(match))]
        before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        heap: list[tuple[int, int, bytes, bytes]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < len(ids):
                rank = self.ranks.get(parts[left] + parts[after[left]])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, parts[left], parts[after[left]]))

        for left in range(len(ids)):
            offer(left)
        while heap:
            rank, left, a, b = heapq.heappop(heap)
            right = after[left]
            if parts[left] != a or right >= len(ids) or parts[right] != b:
                continue  # an older pair
            ids[left], parts[left], parts[right] = rank, a + b, b""
            after[left] = after[right]
            if after[left] < len(ids):
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [rank for rank, part in zip(ids, parts) if part]

    def remember(self, pieces: set[bytes]) -> None:
        """Encode and decode pieces of text that are not known yet; no match crosses their edges."""
        new = pieces.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED_PIECES // 2:
            self.known, self.older, new = {}, self.known, pieces
            self.differs = {piece: decoded for piece, decoded in self.differs.items() if piece in self.older}
        again = new.intersection(self.older)
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        new = new.difference(again)
        whole, matched = [], {}
        for piece in new:
            spelled = piece.decode()
            found = self.pattern.findall(spelled)
            if len(found) == 1 and len(found[0]) == len(spelled):
                whole.append(piece)  # the usual case: a piece is one match
            else:
                matched[piece] = [match.encode() for match in found]
        missing = {match for matches in matched.values() for match in matches}.difference(self.known, whole)
        whole.extend(missing)
        for match, (ids, decoded) in zip(whole, self.matches(whole)):
            self.known[match] = ids
            if decoded != match:
                self.differs[match] = decoded
        for piece, matches in matched.items():
            self.known[piece] = b" ".join([self.known[match] for match in matches])
            decoded = b"".join([self.differs.get(match, match) for match in matches])
            if decoded != piece:
                self.differs[piece] = decoded

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        """(ids as decimal text, decoded bytes) of each text."""
        cut = [self._pieces(text) for text in texts]
        self.remember({piece for pieces in cut for piece in pieces})
        done = []
        for pieces in cut:
            decoded = [self.differs.get(piece, piece) for piece in pieces] if self.differs else pieces
            done.append((b" ".join(map(self.known.__getitem__, pieces)), b"".join(decoded)))
        return done

    def _pieces(self, text: bytes) -> list[bytes]:
        """Pieces of the text whose edges no match crosses. Where single spaces and line
        breaks are the only white space between words, those are the edges, a space going
        with the word behind it as the pattern has it; else the matches themselves."""
        if not text:
            return []
        spelled = text.decode()
        if " ".join(spelled.split()) != spelled.replace("\n", " "):
            return [match.encode() for match in self.pattern.findall(spelled)]
        pieces = []
        for line in text.split(b"\n"):
            first, *rest = line.split(b" ")
            pieces.append(first)
            pieces.extend([b" " + word for word in rest])
            pieces.append(b"\n")
        return pieces[:-1]


_CODERS: dict[tuple[str, str], Bpe] = {}


def coder(path: str, pattern: str) -> Bpe:
    """One coder per worker and vocabulary."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Bpe(path, pattern)
    return _CODERS[path, pattern]


def encoded_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key`, n_tokens, ids_sha256 (of the decimal ids, joined by
    one space), decoded_sha256 (of the bytes that the ids decode to).

    `path` is a .tiktoken file that every executor has, `pattern` splits texts. Matches of
    the pattern are encoded one by one; a worker encodes a distinct match once while it
    remembers it. A null or empty text has no ids; null keys stay null, repeated rows each
    get a row, other columns are not read. No row leaves its partition."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            done = coder(path, pattern).encode(raw(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([ids.count(b" ") + 1 if ids else 0 for ids, _ in done], pa.int64()),
                    pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in done], pa.string()),
                    pa.array([hashlib.sha256(decoded).hexdigest() for _, decoded in done], pa.string()),
                ],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(digest, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
