"""Product codes of vectors by Lloyd rounds that look at active entries only (operator 12).

Vectors become whole numbers and are cut into equal parts; each part position has a codebook.
Rows are packed: one row of a saved table holds some thousand vectors with the entry that
each part is assigned to, the exact squared distance to it, and the sums and counts by entry
that the next codebooks are made of. A round reads the packs and writes them anew. A part
whose entry did not move is compared with the entries that moved only, against the distance
it has stored; the entries that stayed were no nearer before and are no nearer now. Parts
whose entry moved look at all entries. The packs of the round before are removed when the
next ones are written, so two rounds are on disk at most; nothing is shuffled but the sums,
and the driver holds the codebooks alone."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolecast.operators.lookups import lookup_join
from rolecast.session import new_path, remove, saved

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components of a pack.
PACK_CELLS = 1 << 19


@dataclass
class Codebooks:
    """books[part, entry, position]; moved[part, entry]: not the same as in the round before."""

    books: np.ndarray
    moved: np.ndarray

    def next(self, sums: np.ndarray, counts: np.ndarray) -> Codebooks:
        """Each entry becomes the floor of the mean of its parts; unused ones stay.

        `sums` and `counts` are whole numbers of any size."""
        used = counts > 0
        means = sums // np.where(used, counts, 1)[:, :, None]
        books = np.where(used[:, :, None], means, self.books).astype(np.int64)
        return Codebooks(books, (books != self.books).any(axis=2))

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def distances(values: np.ndarray, entry: np.ndarray) -> np.ndarray:
    apart = values - entry
    return np.einsum("ij,ij->i", apart, apart)


def look_at(values: np.ndarray, book: np.ndarray, entries: np.ndarray, code: np.ndarray, best: np.ndarray) -> None:
    """Compare each row of `values` with some entries: `code` and `best` become those of the
    nearest so far, of equally near ones the lowest."""
    for entry in entries.tolist():
        found = distances(values, book[entry])
        nearer = (found < best) | ((found == best) & (entry < code))
        code[nearer], best[nearer] = entry, found[nearer]


def assign_all(values: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row, and the squared distance."""
    code, best = np.zeros(len(values), np.uint8), distances(values, book[0])
    look_at(values, book, np.arange(1, len(book)), code, best)
    return code, best


def assign_active(values: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, best: np.ndarray) -> None:
    """As assign_all, from what the round before has stored."""
    stale = moved[code]
    code[stale], best[stale] = assign_all(values[stale], book)
    fixed = np.flatnonzero(~stale)
    if moved.any() and len(fixed):
        code_, best_ = code[fixed], best[fixed]
        look_at(values[fixed], book, np.flatnonzero(moved), code_, best_)
        code[fixed], best[fixed] = code_, best_


def sums_by_entry(values: np.ndarray, codes: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums[part, entry, position] and counts[part, entry] of values[row, part, position]."""
    n, parts, width = values.shape
    sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
    for part in range(parts):
        order = np.argsort(codes[:, part], kind="stable")
        counts[part] = np.bincount(codes[:, part], minlength=entries)
        used = np.flatnonzero(counts[part])
        starts = (np.cumsum(counts[part]) - counts[part])[used]
        sums[part, used] = np.add.reduceat(values[order, part], starts, axis=0)
    return sums, counts


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as their range allows; the first byte tells how many."""
    most = max(int(values.max(initial=0)), -int(values.min(initial=0)) - 1)
    size = next(size for size in (2, 4, 8) if most < 1 << (8 * size - 1))
    return bytes([size]) + values.astype(f"<i{size}").tobytes()


def widen(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)


def _pack_schema(key: str, label: str) -> str:
    return f"keys array<{key}>, labels array<{label}>, cells binary, codes binary, best binary, sums binary, counts binary"


def _pack(keys: pa.Array, labels: pa.Array, values: np.ndarray, codes: np.ndarray, best: np.ndarray, entries: int, names: list[str]) -> pa.RecordBatch:
    sums, counts = sums_by_entry(values, codes, entries)
    blobs = [narrow(values), codes.tobytes(), narrow(best), narrow(sums), narrow(counts)]
    return pa.RecordBatch.from_arrays([keys, labels, *[pa.array([blob], pa.binary()) for blob in blobs]], names=names)


def _one_list(column: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


NAMES = ["keys", "labels", "cells", "codes", "best", "sums", "counts"]


def pack_first(books: Codebooks, parts: int, size: int) -> Callable:
    """Rows of key, label and vector become packs, assigned by looking at all entries."""
    entries, width = books.books.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), size):
                rows = batch.slice(start, size)
                cells = np.asarray(pc.list_flatten(rows.column(2)).cast(pa.float64()))
                values = np.floor(cells * SCALE).astype(np.int64).reshape(len(rows), parts, width)
                found = [assign_all(values[:, part], books.books[part]) for part in range(parts)]
                codes, best = (np.stack(columns, axis=1) for columns in zip(*found))
                yield _pack(_one_list(rows.column(0)), _one_list(rows.column(1)), values, codes, best, entries, NAMES)

    return run


def pack_again(books: Codebooks) -> Callable:
    """Packs of one round become those of the next."""
    parts, entries, width = books.books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                cells, codes, best = (row.column(name)[0].as_py() for name in ("cells", "codes", "best"))
                values = widen(cells).reshape(-1, parts, width)
                codes = np.frombuffer(codes, np.uint8).reshape(-1, parts).copy()
                best = widen(best).reshape(-1, parts)
                for part in range(parts):
                    code, near = codes[:, part].copy(), best[:, part].copy()
                    assign_active(values[:, part], books.books[part], books.moved[part], code, near)
                    codes[:, part], best[:, part] = code, near
                yield _pack(row.column("keys"), row.column("labels"), values, codes, best, entries, NAMES)

    return run


def totals(packs: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts over all packs, as Python's whole numbers: one row per number of the codebooks."""
    parts, entries, width = shape
    n_sums = parts * entries * width

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = sum(np.concatenate([widen(s), widen(c)]) for s, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            if len(batch):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(added)), pa.int32()), pa.array(added, pa.int64())], names=["place", "part_sum"])

    parts_ = packs.select("sums", "counts").mapInArrow(add, "place int, part_sum long")
    whole = parts_.groupBy("place").agg(F.sum(F.col("part_sum").cast("decimal(38,0)")).alias("total"))
    numbers = np.zeros(n_sums + parts * entries, object)
    for row in whole.collect():
        numbers[row["place"]] = int(row["total"])
    return numbers[:n_sums].reshape(shape), numbers[n_sums:].reshape(parts, entries)


def code_rows(parts: int) -> Callable:
    hexes = np.array([f"{value:02x}" for value in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                codes = np.frombuffer(batch.column(2)[i].as_py(), np.uint8).reshape(-1, parts)
                best = widen(batch.column(3)[i].as_py()).reshape(-1, parts)
                text = ["".join(row) for row in hexes[codes].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, batch.column(1)[i].values, pa.array(text, pa.string()), pa.array(best.sum(axis=1), pa.int64())],
                    names=["key", "label", "code", "error"],
                )

    return run


def finite(vector) -> F.Column:
    """Neither null nor with a component that is null, infinite or no number."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def vector_codes(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per row of `vectors` that is kept: `key`, code, error, label_error, codebooks_sha256.

    Rows go whose vector is null or has a null or non-finite component. Of equal keys the
    smaller vector comes first when the starting entries are chosen; a null key comes last.
    With fewer rows than entries each row is an entry. Repeated rows are rows like others;
    null labels count as equal; an empty table gives no rows; other columns are not read.
    Vectors of different lengths, or of a length that cannot be cut into equal parts, end
    with a ValueError, and so do components so large that the error of a row could pass 63
    bits. Numbers are exact: sums of a pack are 64-bit, those of all packs decimals."""
    spark = vectors.sparkSession
    kind, label_kind = vectors.schema[key].dataType, vectors.schema[label].dataType
    schema = T.StructType(
        [T.StructField(key, kind), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
        + [T.StructField("label_error", T.LongType()), T.StructField("codebooks_sha256", T.StringType())]
    )
    given = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    kept = given.where(finite(F.col("vector")))
    size, largest = F.size("vector"), F.array_max(F.transform("vector", lambda x: F.abs(x)))
    measured = kept.agg(F.min(size).alias("least"), F.max(size).alias("most"), F.max(largest).alias("largest")).first()
    if measured["most"] is None:
        return spark.createDataFrame([], schema)
    length = measured["most"]
    if measured["least"] != length or length % parts:
        raise ValueError(f"vectors of {measured['least']} to {length} components cannot be cut into {parts} equal parts")
    if 4 * length * (SCALE * (measured["largest"] or 0) + 1) ** 2 >= 2**63:
        raise ValueError(f"components up to {measured['largest']} are too large for errors of 63 bits")
    width = length // parts
    starts = [row["vector"] for row in kept.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).collect()]
    first = np.floor(np.array(starts, float).reshape(len(starts), parts, width) * SCALE).astype(np.int64)
    books = Codebooks(np.ascontiguousarray(first.transpose(1, 0, 2)), np.ones((parts, len(starts)), bool))
    pack_kind = _pack_schema(kind.simpleString(), label_kind.simpleString())
    packed = kept.mapInArrow(pack_first(books, parts, max(1, PACK_CELLS // max(1, length))), pack_kind)
    path = new_path(spark, "vector-packs")
    packed.write.parquet(path)
    for _ in range(rounds):
        packs = spark.read.schema(packed.schema).parquet(path)
        books = books.next(*totals(packs, books.books.shape))
        if not books.moved.any():
            break  # the next rounds would change nothing
        before, path = path, new_path(spark, "vector-packs")
        packs.mapInArrow(pack_again(books), pack_kind).write.parquet(path)
        remove(spark, before)
    packs = spark.read.schema(packed.schema).parquet(path)
    found = f"key {kind.simpleString()}, label {label_kind.simpleString()}, code string, error long"
    rows = packs.select("keys", "labels", "codes", "best").mapInArrow(code_rows(parts), found)
    rows = rows.withColumn("same", F.when(F.col("label").isNull(), "").otherwise(F.concat(F.lit("="), F.col("label").cast("string"))))
    by_label = saved(rows.groupBy("same").agg(F.sum("error").alias("label_error")), "label-errors")
    joined = lookup_join(rows, by_label, "same", ["key", "code"])
    return joined.select(F.col("key").alias(key), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same for a table `embeddings` in DuckDB, one pair of queries per round."""
    steps = [
        f"""with kept as (
    select row_number() over (order by vec_id nulls last, embedding) - 1 as r, vec_id, label, embedding from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
cells as materialized (
    select r, c // (len(embedding) // {parts}) as p, c % (len(embedding) // {parts}) as j, floor({SCALE}::double * embedding[c + 1])::bigint as x
    from (select *, unnest(range(len(embedding))) as c from kept)
),
book0 as materialized (select p, r as e, j, x as c from cells where r < {entries})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""near{i} as materialized (
    select r, p, min(d * {entries} + e) // {entries} as d, min(d * {entries} + e) % {entries} as e
    from (select r, p, e, sum((x - c)::hugeint * (x - c)) as d from cells join book{i} using (p, j) group by r, p, e) group by r, p
)"""
        )
        if i < rounds:
            steps.append(
                f"""book{i + 1} as materialized (
    select b.p, b.e, b.j, if(n is null, b.c, (s - ((s % n) + n) % n) // n)::bigint as c
    from book{i} b left join (
        select p, e, j, sum(x)::hugeint as s, count(*)::hugeint as n from cells join near{i} using (r, p) group by p, e, j
    ) using (p, e, j)
)"""
            )
    return (
        ",\n".join(steps)
        + f""",
codes as (select r, string_agg(printf('%02x', e::int), '' order by p) as code, sum(d)::bigint as error from near{rounds} group by r)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
       (select sha256(string_agg(c::varchar, ',' order by p, e, j)) from book{rounds}) as codebooks_sha256
from codes join kept using (r)"""
    )
