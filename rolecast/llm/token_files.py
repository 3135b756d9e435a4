"""Token ids in binary shard files with keyed access (operator 4).

One shard is one file; integers are little-endian:

    8 bytes   b"TOKSHRD1"
    8 bytes   length of the header
    header    JSON: rows, tokens, id_bytes, keys, level_bits, and the length of each section
    hash      bits of the minimal perfect hash of the distinct keys
    entries   per slot of the hash: fingerprint (u32) and first row of the key (u32)
    offsets   rows + 1 token positions (u64)
    keys      UTF-8 keys, each behind its length (u32); a null key has length 0xFFFFFFFF
    ids       the raw ids, u16 if the vocabulary allows it, else u32

A lookup hashes the key, reads its slot, compares the fingerprint and slices the ids; it
touches the same number of entries whatever the number of rows."""

from __future__ import annotations

import json
import sys
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rolecast.llm.perfect_hash import PerfectHash
from rolecast.llm.texts import raw, slices, span_hashes
from rolecast.llm.token_counts import Remembered, drops_spaces, encode_words, lowers, split_words
from rolecast.session import new_path, saved

MAGIC = b"TOKSHRD1"
NULL = 0xFFFFFFFF
#: Bytes of text of one shard, on average.
SHARD_BYTES = 12_000_000
#: Distinct words, with their ids, that a worker remembers.
REMEMBERED_IDS = 1_000_000


def key_hashes(keys: list[bytes | None]) -> np.ndarray:
    """64-bit hashes of keys; null differs from every string."""
    spelled = [b"\x00" if key is None else b"\x01" + key for key in keys]
    ends = np.cumsum([len(key) for key in spelled], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    return span_hashes(np.frombuffer(b"".join(spelled), np.uint8).astype(np.uint64) + np.uint64(1), starts, ends)


def pack(keys: list[bytes | None], ids: list[bytes], id_bytes: int) -> bytes:
    """A shard file of rows in order; equal keys must stand together."""
    hashes = key_hashes(keys)
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
    if len(np.unique(hashes[first])) < len(first):
        raise ValueError("equal keys must stand together, and different keys must differ in their hashes")
    index = PerfectHash.build(hashes[first])
    entries = np.zeros((len(first), 2), "<u4")
    entries[index.slots(hashes[first])] = np.stack([hashes[first] >> np.uint64(32), first], axis=1)
    offsets = np.concatenate([[0], np.cumsum([len(row) // id_bytes for row in ids])]).astype("<u8")
    named = b"".join(NULL.to_bytes(4, "little") if key is None else len(key).to_bytes(4, "little") + key for key in keys)
    sections = [index.bits.tobytes(), entries.tobytes(), offsets.tobytes(), named, *ids]
    header = json.dumps(
        {
            "rows": len(keys),
            "tokens": int(offsets[-1]),
            "id_bytes": id_bytes,
            "level_bits": index.sizes,
            "sections": [len(part) for part in sections[:4]],
        }
    ).encode()
    return b"".join([MAGIC, len(header).to_bytes(8, "little"), header, *sections])


class Shard:
    """A shard file in memory."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a token shard")
        at = 16 + int.from_bytes(content[8:16], "little")
        header = json.loads(content[16:at])
        parts = []
        for size in header["sections"]:
            parts.append(content[at : at + size])
            at += size
        self.rows = header["rows"]
        self.index = PerfectHash.load(header["level_bits"], np.frombuffer(parts[0], "<u8"))
        self.entries = np.frombuffer(parts[1], "<u4").reshape(-1, 2)
        self.offsets = np.frombuffer(parts[2], "<u8").astype(np.int64)
        self.named = parts[3]
        self.ids = np.frombuffer(content, f"<u{header['id_bytes']}", header["tokens"], at)

    def keys(self) -> list[bytes | None]:
        found, at = [], 0
        for _ in range(self.rows):
            size = int.from_bytes(self.named[at : at + 4], "little")
            at += 4
            found.append(None if size == NULL else self.named[at : at + size])
            at += 0 if size == NULL else size
        return found

    def rows_of(self, keys: list[bytes | None]) -> np.ndarray:
        """First row of each key, -1 where its fingerprint is not in the shard."""
        if not len(self.entries):
            return np.full(len(keys), -1, np.int64)
        hashes = key_hashes(keys)
        slots = self.index.slots(hashes)
        known = (slots >= 0) & (self.entries[slots, 0] == hashes >> np.uint64(32))
        return np.where(known, self.entries[slots, 1].astype(np.int64), -1)

    def ids_of(self, row: int) -> np.ndarray:
        return self.ids[self.offsets[row] : self.offsets[row + 1]]


def raw_ids(id_bytes: int) -> Callable[[list[int]], bytes]:
    """A function that gives the bytes of a few ids; an array for each would cost more."""
    if sys.byteorder == "big":
        return lambda ids: np.array(ids, f"<u{id_bytes}").tobytes()
    kind = next(code for code in "HIL" if array(code).itemsize == id_bytes)
    return lambda ids: array(kind, ids).tobytes()


_ENCODERS: dict[tuple[str, int], Remembered] = {}


def _encoder(path: str, id_bytes: int) -> Remembered:
    if (path, id_bytes) not in _ENCODERS:
        _ENCODERS[path, id_bytes] = Remembered(
            encode_words(path, raw_ids(id_bytes)), REMEMBERED_IDS
        )
    return _ENCODERS[path, id_bytes]


def encode_texts(texts: list[bytes], path: str, id_bytes: int) -> list[bytes]:
    """Raw ids of each text."""
    memory = _encoder(path, id_bytes)
    if not drops_spaces(path):
        return memory.compute(texts)
    lower = lowers(path)
    split = [split_words(text, lower) for text in texts]
    known = memory.of([word for text in split for word in text])
    return [b"".join(map(known.__getitem__, text)) for text in split]


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all texts and write them to `folder` in ascending key order.

    Returns the manifest, one row per shard: shard, n_rows, n_tokens, first (tokens in
    earlier shards). Null texts are empty, null keys come first, rows with equal keys stand
    together in the order of their text checksums. A hot key may fill several shards. Each
    file is written under a name of its own and then moved, so a repeated task replaces a
    file by the same bytes. `folder` is a URI or path that all executors reach."""
    vocabulary = _vocabulary_size(path)
    id_bytes = 2 if max(vocabulary, end_id or 0) <= 1 << 16 else 4
    end = b"" if end_id is None else np.array([end_id], f"<u{id_bytes}").tobytes()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = ["key", F.crc32(F.coalesce("text", F.lit("")).cast("binary")), F.octet_length("text")]
    ordered = rows.repartitionByRange(total // SHARD_BYTES + 1, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, keys, ids = TaskContext.get().partitionId(), [], []
        for batch in slices(batches):
            keys.extend(batch.column("key").cast(pa.binary()).to_pylist())
            ids.extend(row + end for row in encode_texts(raw(batch.column("text")), path, id_bytes))
        if keys:
            put(f"{folder}/shard-{shard:06d}.tok", pack(keys, ids, id_bytes))
            counts = [shard, len(keys), sum(map(len, ids)) // id_bytes]
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()) for n in counts], names=["shard", "n_rows", "n_tokens"])

    spelled = ordered.select(F.col("key").cast("string"), "text")
    manifest = saved(spelled.mapInArrow(write, "shard long, n_rows long, n_tokens long"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def put(path: str, content: bytes) -> None:
    """Write a file in one step."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    folder, _, last = name.rpartition("/")
    store.create_dir(folder, recursive=True)
    unfinished = f"{folder}/.{last}-{uuid.uuid4().hex}"
    with store.open_output_stream(unfinished) as out:
        out.write(content)
    store.move(unfinished, name)


def shard_files(spark: SparkSession, folder: str) -> DataFrame:
    """shard and content of each file; one file is read by one task at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.tok").load(folder)
    return files.select(F.regexp_extract("path", r"shard-(\d+)\.tok$", 1).cast("long").alias("shard"), "content")


DIGEST = "shard long, row long, key string, n_tokens long, offset long, ids_crc32 long, found boolean"


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per stored row, each reached through its key."""
    for batch in batches:
        for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
            file = Shard(content.as_buffer().to_pybytes())
            keys = file.keys()
            first = file.rows_of(keys)
            same = np.array([a == b for a, b in zip(keys[1:], keys)], bool)
            run = np.flatnonzero(np.concatenate([[True], ~same]))  # rows with equal keys stand together
            rows = first + np.arange(len(keys)) - np.repeat(run, np.diff([*run, len(keys)]))
            sums = [zlib.crc32(file.ids_of(row).astype("<u4").tobytes()) for row in rows.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(keys), shard), pa.int64()),
                    pa.array(rows, pa.int64()),
                    pa.array([None if key is None else key.decode() for key in keys], pa.string()),
                    pa.array(file.offsets[rows + 1] - file.offsets[rows], pa.int64()),
                    pa.array(file.offsets[rows], pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(first >= 0, pa.bool_()),
                ],
                names=["shard", "row", "key", "n_tokens", "offset", "ids_crc32", "found"],
            )


def read_by_key(spark: SparkSession, folder: str, keys: list[str | None]) -> DataFrame:
    """shard, key, ids of the rows stored under `keys`, a short list; each shard answers for
    itself through its hash. Fingerprints have 32 bits, so the stored key is compared too."""
    wanted = [None if key is None else key.encode() for key in keys]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                file = Shard(content.as_buffer().to_pybytes())
                stored = file.keys()
                for key, row in zip(wanted, file.rows_of(wanted).tolist()):
                    while 0 <= row < file.rows and stored[row] == key:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([shard], pa.int64()),
                                pa.array([None if key is None else key.decode()], pa.string()),
                                pa.array([file.ids_of(row).tolist()], pa.list_(pa.int64())),
                            ],
                            names=["shard", "key", "ids"],
                        )
                        row += 1

    return shard_files(spark, folder).mapInArrow(find, "shard long, key string, ids array<long>")


def token_digests(docs: DataFrame, path: str, end_id: int | None = None, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write `docs` as token files, read them back and return one row per row of `docs`:
    `key`, start (ids of all rows before it), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), shard.

    Null texts have the end id only; null keys come first; repeated rows each have a row;
    an empty table gives no rows and no files."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    manifest = write_token_files(docs, path, folder, end_id, key, text)
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *(T.StructField(name, T.LongType()) for name in ("start", "n_tokens", "ids_crc32", "shard"))])
    if manifest.isEmpty():
        return spark.createDataFrame([], schema)
    read = shard_files(spark, folder).mapInArrow(digests, DIGEST)
    checked = read.withColumn("key", F.when(F.col("found"), F.col("key")).otherwise(F.raise_error(F.lit("a stored key is not in its index"))))
    placed = checked.join(F.broadcast(manifest.select("shard", "first")), "shard")  # one row per file
    return placed.select(F.col("key").cast(kind).alias(key), (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "shard")
