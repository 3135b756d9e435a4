"""Hierarchical Pitman-Yor language model over words (operator 10).

A context is the two words before, its parent the one word before, and that one's parent
nothing. Entries are (two words before, word), (word before, word) and (word), told apart by
64-bit hashes, and live in tiers of buckets: those of two and one words by the hash of their
context, so that a bucket holds whole restaurants, those of no word by the word. Contexts of
one word with very many entries are dealt out by word too, and the totals of these and of the
root are partial sums that the driver adds up, a few numbers per bucket.

Documents are taken in parts of some megabytes. A part asks the buckets of the first tier for
its distinct entries, with their counts in training documents; a bucket asks those of the
next tier for the parents of its entries. Who asks gets its answers in the order of its
questions, so in each sweep only numbers move: tables up, which are the customers of the
parents, and chances down. At last the parts get the probabilities averaged over the last
sweeps, and add up the scores of their documents. All tables between are saved; none is held
by the driver.

Entries are sorted by the word before, the second word before and the word, so that lists of
them are short when each number is written as its step from the one before. The first tier is
worked on in rounds of buckets, and tables are removed as soon as nothing reads them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolecast.llm.languages import held_out
from rolecast.llm.seating import LEVELS, STRENGTH, draw_tables
from rolecast.llm.texts import Words, mix, raw, slices
from rolecast.session import exists, new_path, remove

#: Text bytes of a part, and of the documents for each bucket.
PART_BYTES = 8_000_000
BUCKET_BYTES = 16_000_000
SWEEPS = 4
#: Sweeps at the end whose probabilities are averaged.
AVERAGED = 2
#: The tokens behind the last and before the first word; no hash of a word is special, they only have to be fixed.
END = np.uint64(0x452821E638D01377)
START = np.uint64(0xBE5466CF34E90C6C)
#: A part names the words before that have this share of its entries; those with more than
#: this share of a bucket's entries in all are dealt out by word.
FREQUENT = 1e-3
HOT = 0.25
#: Share of the tokens, and bytes of the texts looked at, for words that have a short name in lists.
USUAL = 2.0**-19
USUAL_BYTES = 64_000_000
NONE = np.zeros(0, np.uint64)
#: Rounds in which the buckets of the first tier are worked on, and how many of them a sweep takes at once.
ROUNDS = 8
AT_ONCE = 4
#: Whether shuffle files go when the table that they were made for is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Kinds of rows, in the order in which a bucket reads them.
PART, ASKED, STATIC, CHILD, STATE, UP, DOWN, SUMS, FREQUENTS, ONCE, WORDS = range(11)
CELLS = ("a", "b", "c", "d", "e")
SCHEMA = "level int, bucket long, kind int, peer long, x long, y long, " + ", ".join(f"{name} binary" for name in CELLS)
_FIELDS = [("level", pa.int32()), ("bucket", pa.int64()), ("kind", pa.int32()), *((name, pa.int64()) for name in ("peer", "x", "y")), *((name, pa.binary()) for name in CELLS)]


def rows_of(tables: list[Table], kind: int, *turns: int) -> DataFrame:
    """The rows of a kind, of some rounds or of all."""
    paths = [path for table in tables for path in table.folders(kind, turns or range(ROUNDS))]
    spark, schema = tables[0].spark, tables[0].schema
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def steps(values: np.ndarray) -> np.ndarray:
    """Each number less the one before, modulo its width; `np.cumsum` turns it back."""
    return np.diff(values, prepend=values.dtype.type(0))


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, the bytes of equal weight together."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(cell: bytes, kind: str, stepped: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(cell), np.uint8)
    values = np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)
    return np.cumsum(values, dtype=kind) if stepped else values


def row(level: int, bucket: int, kind: int, peer: int = 0, x: int = 0, y: int = 0, **cells: np.ndarray) -> pa.RecordBatch:
    numbers = [pa.array([value], type_) for value, (_, type_) in zip((level, bucket, kind, peer, x, y), _FIELDS)]
    return pa.RecordBatch.from_arrays([*numbers, *(pa.array([packed(cells[name]) if name in cells else None], pa.binary()) for name in CELLS)], schema=pa.schema(_FIELDS))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class Table:
    """Saved rows, in folders by kind and round."""

    def __init__(self, df: DataFrame, label: str):
        self.spark, self.schema, self.path = df.sparkSession, df.schema, new_path(df.sparkSession, label)
        turn = F.when((F.col("level") == 2) & (F.col("bucket") >= 0), F.col("bucket") % ROUNDS).otherwise(0)
        with shuffles_removed(self.spark):
            df.withColumn("folder", F.col("kind") * ROUNDS + turn).write.partitionBy("folder").parquet(self.path)

    def folders(self, kind: int, turns: Iterable[int]) -> list[str]:
        paths = [f"{self.path}/folder={kind * ROUNDS + turn}" for turn in turns]
        return [path for path in paths if exists(self.spark, path)]

    def rows(self, kind: int, *turns: int) -> DataFrame:
        return rows_of([self], kind, *turns)

    def drop(self, kind: int, *turns: int) -> None:
        for path in self.folders(kind, turns or range(ROUNDS)):
            remove(self.spark, path)


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the second word before, of the word before and of each token, and the number
    of tokens of each text. The words of a text in lower case (A to Z only) are followed by
    its end, and have its start before them."""
    words = Words([text.lower() for text in texts])
    counts = np.diff(words.first)
    ends = words.first[1:] + np.arange(len(texts))  # each text before has one token more than words
    hashes = np.empty(len(words) + len(texts), np.uint64)
    hashes[np.arange(len(words)) + np.repeat(np.arange(len(texts)), counts)] = words.hashes()
    hashes[ends] = END
    before = []
    for back in (2, 1):
        found = np.concatenate([np.full(back, START), hashes])[: len(hashes)]
        for i in range(back):
            at = ends - counts + i
            found[at[at <= ends]] = START
        before.append(found)
    return before[0], before[1], hashes, counts + 1


def folded(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each row of some columns of hashes; 0 if there are none."""
    value = np.zeros(1, np.uint64)
    for column in columns:
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + column + np.uint64(1))
    return value


def in_order(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of 64-bit values in their order, and the values in it. Leading bits with the
    place behind them are sorted, which is faster than to sort places; equal leading bits
    of different values are rare, and then places are sorted after all."""
    bits = np.uint64(len(values).bit_length())
    places = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
    places.sort()
    places &= (np.uint64(1) << bits) - np.uint64(1)
    order = places.view(np.int64)
    found = values[order]
    if (found[1:] < found[:-1]).any():
        order = np.argsort(values)
        found = values[order]
    return order, found


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct value, in the order of values, and which one each value is."""
    order, found = in_order(values)
    new = np.ones(len(values), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    del found
    which = np.empty(len(values), np.int32 if len(values) < 1 << 31 else np.int64)
    which[order] = np.cumsum(new, dtype=which.dtype) - which.dtype.type(1)
    return order[new], which


def order_of(columns: list[np.ndarray]) -> np.ndarray:
    """Places of entries by word before, second word before and word, so far as 64 bits tell
    them apart: it only makes lists shorter."""
    if len(columns) == 1:
        return np.argsort(columns[0])
    bits, key = (32, 32) if len(columns) == 2 else (24, 20, 20), np.uint64(0)
    for column, width in zip([*columns[-2::-1], columns[-1]], bits):
        key = key << np.uint64(width) | column >> np.uint64(64 - width)
    return np.argsort(key)


def contexts_of(columns: list[np.ndarray]) -> np.ndarray:
    return np.broadcast_to(folded(columns[:-1]), len(columns[-1]))


def shared(contexts: np.ndarray, level: int, hot: np.ndarray) -> np.ndarray:
    """Whether a restaurant is spread over buckets: the root, hot words before, and the one
    that every document enters first."""
    return np.ones(len(contexts), bool) if level == 0 else np.isin(contexts, hot if level == 1 else folded([np.array([START])] * 2))


def questions(columns: list[np.ndarray], buckets: list[int], hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, slice]]]:
    """A place of each distinct entry by bucket, which one of these each entry is, and the
    buckets with their slices of the distinct ones."""
    level = len(columns) - 1
    first, which = distinct(folded(columns))
    sorted_ = order_of([column[first] for column in columns])
    first = first[sorted_]
    chosen = [column[first] for column in columns]
    contexts = contexts_of(chosen)
    spread = np.where(shared(contexts, level, hot), folded(chosen), contexts)
    bucket = ((spread >> np.uint64(32)) * np.uint64(buckets[level]) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket.astype(np.uint16) if buckets[level] <= 1 << 16 else bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[sorted_[order]] = np.arange(len(order))
    bucket = bucket[order]
    edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
    return first[order], rank[which], [(int(bucket[start]), slice(start, end)) for start, end in zip(edges, edges[1:]) if end > start]


def usual_words(rows: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of words that lists name by their place in here: those with a share of
    USUAL or more of the tokens of some USUAL_BYTES of texts. Other words are written as
    hashes, so the choice makes lists shorter and changes nothing else."""
    some = rows.where(F.crc32(F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary")) <= (1 << 32) * min(1, USUAL_BYTES / max(size, 1)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            hashes, n = np.unique(tokens_of(raw(piece.column("text")))[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n, pa.int64())], names=["word", "n"])

    path = new_path(rows.sparkSession, "words")
    with shuffles_removed(rows.sparkSession):
        some.select("text").mapInArrow(work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).write.parquet(path)
    counts = rows.sparkSession.read.schema("word long, n long").parquet(path)
    tokens = counts.agg(F.sum("n")).first()[0] or 0
    usual = counts.where(F.col("n") >= USUAL * tokens).select("word").collect()
    remove(rows.sparkSession, path)
    return np.sort(np.array([found.word for found in usual], np.int64).view(np.uint64))


def spelled(columns: list[np.ndarray], usual: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted columns of hashes as the distinct hashes (usual ones by their place) and their
    numbers; all but words behind two others are steps."""
    both = np.concatenate(columns)
    first, which = distinct(both)
    numbers = np.split(which.astype("<u4"), len(columns))
    words = both[first]
    place = np.searchsorted(usual, words)
    known = np.append(usual, np.uint64(0))[place] == words
    known &= place < len(usual)
    return {
        "a": steps(words[~known]),
        "b": np.concatenate([found if i == 2 else steps(found) for i, found in enumerate(numbers)]),
        "e": steps(place[known].astype("<u4")),
    }


def read(asker: dict, n: int, usual: np.ndarray) -> list[np.ndarray]:
    words = np.concatenate([usual[unpacked(asker["e"], "<u4", stepped=True)], unpacked(asker["a"], "<u8", stepped=True)])
    words.sort()
    return [words[found if i == 2 else np.cumsum(found, dtype="<u4")] for i, found in enumerate(np.split(unpacked(asker["b"], "<u4"), n))]


def ask(docs: DataFrame, buckets: list[int], usual: np.ndarray = NONE) -> Table:
    """The rows of parts, of their questions and of their frequent words before, saved: a
    part's tokens are places in the list of its questions, by bucket."""
    kind = docs.schema["key"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for i, batch in enumerate(slices(batches, "text", PART_BYTES)):
            keys, held, part = batch.column("key"), batch.column("held_out"), task << 32 | i
            lists = [("keys", pa.list_(keys.type)), ("held_out", pa.list_(pa.bool_()))]
            schema = pa.schema([*_FIELDS, *lists])

            def wide(found: pa.RecordBatch, *values: pa.Array) -> pa.RecordBatch:
                more = [pa.ListArray.from_arrays([0, len(value)], value) for value in values] or [pa.nulls(1, type_) for _, type_ in lists]
                return pa.RecordBatch.from_arrays([*found.columns, *more], schema=schema)

            *columns, lengths = (np.concatenate(found) for found in zip(*(tokens_of(raw(piece.column("text"))) for piece in slices([batch]))))
            train = np.repeat(~np.array(held, bool), lengths)
            first, which, asked = questions(columns, buckets, NONE)
            counts = np.bincount(which, train, len(first)).astype("<i4")
            yield wide(row(0, part, PART, a=lengths.astype("<i4"), b=which.astype("<i4")), keys, held)
            columns = [column[first] for column in columns]
            for bucket, inside in asked:
                yield wide(row(2, bucket, ASKED, part, c=counts[inside], **spelled([column[inside] for column in columns], usual)))
            before, n = np.unique(folded(columns[1:2]), return_counts=True)
            for context, count in zip(before[n > FREQUENT * len(first)], n[n > FREQUENT * len(first)]):
                yield wide(row(1, -1, FREQUENTS, int(context.view(np.int64)), int(count)))
            yield wide(row(2, -1, SUMS, 0, len(first)))

    return Table(docs.mapInArrow(work, f"{SCHEMA}, keys array<{kind.simpleString()}>, held_out array<boolean>"), "questions")


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[dict]]]]:
    """The rows of each bucket of sorted rows, by kind."""
    bucket, held = None, {}
    for batch in batches:
        for values in (dict(zip(batch.schema.names, cells)) for cells in zip(*(column.to_pylist() for column in batch.columns))):
            if held and values["bucket"] != bucket:
                yield bucket, held
                held = {}
            bucket = values["bucket"]
            held.setdefault(values["kind"], []).append(values)
    if held:
        yield bucket, held


def together(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, (frame.select("level", "bucket", "kind", "peer", "x", "y", *CELLS) for frame in frames))


def dealt(frames: list[DataFrame], buckets: int) -> DataFrame:
    return together(frames).repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind", "peer")


def added(tables: list[Table], kind: int) -> dict[int, tuple[int, int]]:
    sums = rows_of(tables, kind).groupBy("peer").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).collect()
    return {found.peer: (found.x, found.y) for found in sums}


def merged(asked: list[DataFrame], level: int, buckets: list[int], hot: np.ndarray, usual: np.ndarray) -> Table:
    """Saved rows of the buckets of a tier that are asked: what stays (the restaurant, the place of the
    parent and the training tokens of each entry), the entries that each asker asks for, the
    state with one table per word, totals, and questions to the next tier."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in grouped(batches):
            given = rows.pop(ASKED)
            lists, hashes = [[] for _ in range(level + 1)], []
            for asker in given:
                found = read(asker, level + 1, usual)
                hashes.append(folded(found))
                for pieces, column in zip(lists, found):
                    pieces.append(column)
            ends = np.cumsum([len(values) for values in hashes])
            hashes = np.concatenate(hashes)
            first, entry = distinct(hashes)
            del hashes, found, column
            columns = [np.concatenate(lists.pop(0))[first] for _ in range(level + 1)]
            order = order_of(columns)
            rank = np.empty(len(order), "<i4")
            rank[order] = np.arange(len(order), dtype="<i4")
            columns, entry = [column[order] for column in columns], rank[entry]
            n = np.zeros(len(order), "<i8")
            customers = np.zeros(len(order), "<i8") if level < 2 else n
            for asker, which in zip(given, np.split(entry, ends[:-1])):
                yield row(level, bucket, CHILD, asker["peer"], a=steps(which))
                # Entries of an asker are distinct.
                n[which] += unpacked(asker["c"], "<i8" if asker["d"] else "<i4")
                if level < 2:
                    customers[which] += unpacked(asker["d"], "<i8")
            del given, asker, which, entry, first, order, rank
            tables = np.minimum(customers, 1)
            contexts = contexts_of(columns)
            places, restaurant = distinct(contexts)
            order = np.argsort(places)  # restaurants in the order of their entries
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            places, restaurant = places[order], rank[restaurant]
            common = np.flatnonzero(shared(contexts[places], level, hot)) if level else np.zeros(1, np.int64)
            common = np.stack([contexts[places][common].view(np.int64), common], axis=1).reshape(-1)
            stays = {"a": steps(restaurant.astype("<i4")), "d": n, "e": common}
            if level:
                chosen, parent, asked_of = questions(columns[1:], buckets, hot)
                up = [np.bincount(parent, values, len(chosen)).astype("<i8") for values in (n, tables)]
                for number, inside in asked_of:
                    yield row(level - 1, number, ASKED, bucket, c=up[0][inside], d=up[1][inside], **spelled([column[chosen[inside]] for column in columns[1:]], usual))
                stays |= {"b": steps(parent.astype("<i4")), "c": np.array([(number, inside.stop - inside.start) for number, inside in asked_of], np.int64).reshape(-1)}
            yield row(level, bucket, STATIC, **stays)
            tier = Tier(level, bucket, {STATIC: [], CHILD: []}, restaurant, common, customers, tables)
            yield from tier.state()
            yield row(level, bucket, ONCE, 0, int((customers == 1).sum()), int((customers == 2).sum()))
            if not level:
                yield row(level, bucket, WORDS, 0, int((n > 0).sum()), int(n.sum()))

    return Table(dealt(asked, buckets[level]).mapInArrow(work, SCHEMA), f"tier{level}")


@dataclass
class Learned:
    """What the driver holds of the model: a few numbers, and the totals of the restaurants
    that are spread over buckets, per level."""

    discounts: list[float] = field(default_factory=list)
    uniform: float = 1.0
    words: int = 0
    tokens: int = 0
    totals: list[dict[int, tuple[int, int]]] = field(default_factory=lambda: [{} for _ in range(LEVELS)])


@dataclass
class Tier:
    """A bucket at work."""

    level: int
    bucket: int
    rows: dict[int, list[dict]]
    restaurant: np.ndarray  # of each entry
    common: np.ndarray  # context and place, in turn, of the restaurants that are spread
    customers: np.ndarray
    tables: np.ndarray
    sums: np.ndarray | None = None  # of the probabilities averaged

    @classmethod
    def of(cls, level: int, bucket: int, rows: dict[int, list[dict]]) -> Tier:
        (stays,), (state,) = rows[STATIC], rows[STATE]
        customers = unpacked(state["a"], "<i8") if state["a"] else unpacked(stays["d"], "<i8")
        sums = unpacked(state["c"], "<f4") if state["c"] else None
        return cls(level, bucket, rows, unpacked(stays["a"], "<i4", stepped=True), unpacked(stays["e"], "<i8"), customers, unpacked(state["b"], "<i8"), sums)

    def state(self) -> Iterator[pa.RecordBatch]:
        """Rows with the customers (if they change) and tables, and totals of spread restaurants."""
        cells = {"b": self.tables} | ({"a": self.customers} if self.level < 2 else {}) | ({"c": self.sums} if self.sums is not None else {})
        yield row(self.level, self.bucket, STATE, **cells)
        if len(self.common):
            customers, tables = (np.bincount(self.restaurant, values) for values in (self.customers, self.tables))
            for context, place in self.common.reshape(-1, 2).tolist():
                yield row(self.level, self.bucket, SUMS, context, int(customers[place]), int(tables[place]))

    def parent(self) -> np.ndarray:
        """Of each entry, the place of its parent in the questions."""
        return unpacked(self.rows[STATIC][0]["b"], "<i4", stepped=True)

    def parents(self, cell: str, kind: str) -> np.ndarray:
        """Of each entry, what the parent tier says."""
        return np.concatenate([unpacked(found[cell], kind) for found in self.rows[DOWN]])[self.parent()]

    def below(self, learned: Learned) -> np.ndarray:
        return self.parents("a", "<f4").astype(float) if self.level else np.full(len(self.tables), learned.uniform)

    def whole(self, learned: Learned) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of the restaurant of each entry."""
        found = [np.bincount(self.restaurant, values) for values in (self.customers, self.tables)]
        for context, place in self.common.reshape(-1, 2).tolist():
            found[0][place], found[1][place] = learned.totals[self.level][context]
        return found[0][self.restaurant], found[1][self.restaurant]

    def chances(self, learned: Learned) -> np.ndarray:
        """Predictive probability of the word of each entry in its context."""
        discount, (customers, tables) = learned.discounts[self.level], self.whole(learned)
        return (self.customers - discount * self.tables + (STRENGTH + discount * tables) * self.below(learned)) / (STRENGTH + customers)

    def seat(self, learned: Learned, sweep: int) -> Iterator[pa.RecordBatch]:
        """Seat all customers anew, each word given the tables of all others and its chances
        in the parent restaurant; the draws depend on the bucket and the sweep, so a task
        that is run again seats everyone as before."""
        if self.level == 2 and sweep > SWEEPS - AVERAGED:
            self.sums = (self.chances(learned) + (0 if self.sums is None else self.sums)).astype("<f4")
        discount = learned.discounts[self.level]
        new = (STRENGTH + discount * self.whole(learned)[1]) * self.below(learned)
        if self.level < 2:
            self.customers = np.zeros(len(self.tables), np.int64)
            for child, tables in zip(self.rows[CHILD], self.rows[UP], strict=True):
                self.customers[unpacked(child["a"], "<i4", stepped=True)] += unpacked(tables["a"], "<i8")
        self.tables = draw_tables(self.customers, new, discount, np.random.default_rng([self.level, self.bucket, sweep]))
        yield from self.state()
        if self.level:
            stays = self.rows[STATIC][0]
            sums = np.bincount(self.parent(), self.tables).astype("<i8")
            at = 0
            for number, length in unpacked(stays["c"], "<i8").reshape(-1, 2).tolist():
                yield row(self.level - 1, number, UP, self.bucket, a=sums[at : at + length])
                at += length

    def tell(self, learned: Learned, last: bool) -> Iterator[pa.RecordBatch]:
        """Answers to all askers: chances, at last also the training tokens of the word, and
        to parts the logarithm of the averaged chances."""
        chances = self.chances(learned)
        if self.level == 2:
            chances = np.log10((chances + (0 if self.sums is None else self.sums)) / AVERAGED).astype("<f4")
        n = None if not last else self.parents("b", "<i8") if self.level else unpacked(self.rows[STATIC][0]["d"], "<i8")
        for child in self.rows[CHILD]:
            which = unpacked(child["a"], "<i4", stepped=True)
            yield row(self.level + 1, child["peer"], DOWN, self.bucket, a=chances[which].astype("<f4"), **({"b": n[which]} if last else {}))


class Model:
    """The tables of the tiers by round, and the numbers on the driver."""

    def __init__(self, asked: Table, buckets: list[int], usual: np.ndarray = NONE):
        self.buckets, self.learned = buckets, Learned()
        entries = added([asked], SUMS).get(0, (0, 0))[0]
        frequent = asked.rows(FREQUENTS).groupBy("peer").agg(F.sum("x").alias("n")).where(F.col("n") > HOT * entries / buckets[1])
        hot = np.array([found.peer for found in frequent.collect()], np.int64).view(np.uint64)
        self.tiers: list[list[Table]] = [[], [], []]
        for turn in range(ROUNDS):
            self.tiers[2].append(merged([asked.rows(ASKED, turn)], 2, buckets, hot, usual))
            asked.drop(ASKED, turn)
        for level in (1, 0):
            self.tiers[level] = [merged([rows_of(self.tiers[level + 1], ASKED)], level, buckets, hot, usual)]
            for table in self.tiers[level + 1]:
                table.drop(ASKED)
        self.states = list(self.tiers)
        self.down: list[Table | None] = [None] * LEVELS
        for level in range(LEVELS):
            once, twice = added(self.tiers[level], ONCE).get(0, (0, 0))
            self.learned.discounts.append(min(max(once / max(once + 2 * twice, 1), 0.05), 0.95))
            self.learned.totals[level] = added(self.tiers[level], SUMS)
        self.learned.words, self.learned.tokens = added(self.tiers[0], WORDS).get(0, (0, 0))
        self.learned.uniform = 1 / (self.learned.words + 1)

    def run(self, level: int, turns: range, work: Callable[[Tier], Iterator[pa.RecordBatch]], children: bool, up: list[Table]) -> DataFrame:
        read = [(self.tiers[level], STATIC), (self.states[level], STATE)]
        read += ([(self.tiers[level], CHILD)] if children else []) + ([([self.down[level]], DOWN)] if level else [])
        frames = [rows_of(tables, kind, *turns) for tables, kind in read] + ([rows_of(up, UP)] if up else [])

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, rows in grouped(batches):
                yield from work(Tier.of(level, bucket, rows))

        return dealt(frames, self.buckets[level]).mapInArrow(each, SCHEMA)

    def drop(self, level: int, turns: range, *gone: int) -> None:
        for table in {*self.tiers[level], *self.states[level], *([self.down[level]] if level else [])}:
            for kind in gone:
                table.drop(kind, *turns)

    def tell(self, last: bool) -> None:
        """Chances from the root to the first tier."""
        for level in (0, 1):
            learned = self.learned
            self.down[level + 1] = Table(self.run(level, range(1), lambda tier: tier.tell(learned, last), True, []), f"down{level}")

    def sweep(self, number: int) -> None:
        """From the longest context down."""
        up, learned = [], self.learned
        for level in (2, 1, 0):
            new = []
            for turns in [range(at, at + AT_ONCE) for at in range(0, ROUNDS, AT_ONCE)] if level == 2 else [range(1)]:
                new.append(Table(self.run(level, turns, lambda tier: tier.seat(learned, number), level < 2, up), f"seats{level}"))
                self.drop(level, turns, STATE, DOWN)
            for table in up:
                table.drop(UP)
            self.states[level] = up = new
        self.learned.totals = [added(tables, SUMS) for tables in self.states]

    def answers(self) -> list[Table]:
        """What the first tier says to parts. The model is of no use afterwards."""
        learned, said = self.learned, []
        for turn in range(ROUNDS):
            said.append(Table(self.run(2, range(turn, turn + 1), lambda tier: tier.tell(learned, True), True, []), "answers"))
            self.drop(2, range(turn, turn + 1), STATIC, CHILD, STATE, DOWN)
        for level in (1, 0):
            self.drop(level, range(1), STATIC, CHILD, STATE, DOWN)
        return said


def add_up(asked: Table, answers: list[Table], learned: Learned, key: str) -> DataFrame:
    """Scores of the documents of each part, from its answers in the order of buckets."""
    kind = asked.schema["keys"].dataType.elementType.simpleString()
    unknown = learned.tokens + learned.words + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, scores, counts = None, [], []
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {name: batch.column(name)[i] for name in batch.schema.names}
                if cell["bucket"].as_py() != part:
                    part, scores, counts = cell["bucket"].as_py(), [], []
                if not cell["keys"].is_valid:
                    scores.append(unpacked(cell["a"].as_py(), "<f4"))
                    counts.append(unpacked(cell["b"].as_py(), "<i8"))
                    continue
                known = np.concatenate(counts)  # the documents come behind all answers
                lengths, tokens = unpacked(cell["a"].as_py(), "<i4").astype(np.int64), unpacked(cell["b"].as_py(), "<i4")
                first = np.cumsum(lengths) - lengths  # every document has a token
                columns = [
                    cell["keys"].values,
                    cell["held_out"].values,
                    pa.array(lengths),
                    pa.array(np.add.reduceat((known > 0)[tokens].astype(np.int64), first)),
                    pa.array([learned.tokens] * len(lengths), pa.int64()),
                    pa.array(np.add.reduceat(np.log10((known + 1) / unknown)[tokens], first)),
                    pa.array(np.add.reduceat(np.concatenate(scores).astype(float)[tokens], first)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    docs = asked.rows(PART).select("bucket", "kind", "peer", "a", "b", "keys", "held_out")
    said = rows_of(answers, DOWN).select("bucket", "kind", "peer", "a", "b")
    both = docs.unionByName(said, allowMissingColumns=True)
    by_part = both.repartition("bucket").sortWithinPartitions("bucket", F.col("kind").desc(), "peer")
    return by_part.mapInArrow(work, f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def document_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int = 7, part: int = 2) -> DataFrame:
    """One row per row of `docs`: `key`, held_out, n_tokens, n_known (tokens seen in
    training), train_tokens, base_score (add-one unigrams) and score (log10 probability
    under the hierarchical model).

    A document is held out if the checksum of its key is `part` modulo `parts`; a null key
    counts as an empty one. A null or empty text is its end alone. Repeated rows are
    documents of their own. If nothing is trained on, every probability is that of the one
    unknown word, 1. Words and contexts are told apart by 64-bit hashes.

    An asker sends an entry once whatever its count, so frequent words and pairs make no
    large group; a restaurant of two words has a row per different word behind them."""
    rows = docs.select(docs[key].alias("key"), held_out(key, parts, part).alias("held_out"), F.col(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = [size // (8 * BUCKET_BYTES) + 8, size // (2 * BUCKET_BYTES) + 8, size // BUCKET_BYTES + 8]
    usual = usual_words(rows, size)
    asked = ask(rows, buckets, usual)
    model = Model(asked, buckets, usual)
    for sweep in range(SWEEPS):
        model.tell(last=False)
        model.sweep(sweep)
    model.tell(last=True)
    return add_up(asked, model.answers(), model.learned, key)
