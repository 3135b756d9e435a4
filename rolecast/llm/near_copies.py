"""N-gram Jaccard join by a MinHash LSH forest (operator 9).

Every distinct text has TREES labels of up to DEPTH min-hashes; sorted by label, a tree is a
prefix trie, and texts with equal prefixes are neighbours. Prefixes start at DEPTH hashes and
get shorter until the target recall is likely: a link of similarity s is found with chance
1 - (1 - s ** depth) ** TREES, so the links that were missed can be estimated from those that
were not, and the weakest link allowed must reach the target by itself. Neighbours are compared exactly on their sets of
shingles. Texts of one prefix become a block named after its least text, so a text takes part
in few blocks, and a large block is cut into pairs of chunks that are compared apart."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolecast.llm.repeats import distinct_texts, text_id
from rolecast.llm.texts import Words, mix, raw, slices, unused, window_hashes
from rolecast.session import saved

WORDS = 5
#: Links have a similarity of NEAR / 5 or more.
NEAR = 4
#: So many that at full depth even a link of exactly NEAR / 5 is missed with a chance of 5e-6.
TREES = 40
DEPTH = 6
RECALL = 0.99999
#: Shingles and texts of one chunk of a block.
CHUNK_SHINGLES = 500_000
CHUNK_TEXTS = 1_000

_FACTORS = mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64)) | np.uint64(1)
_OFFSETS = mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) + np.uint64(1 << 32))


def shingles(texts: list[bytes], width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted, and the first of each text.

    A text with fewer than `width` words has one shingle, all its words; one without words none."""
    words = Words(texts)
    hashes = words.hashes()
    starts, found = window_hashes(hashes, words.first, width)
    owner = np.searchsorted(words.first, starts, side="right") - 1
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = [window_hashes(hashes[words.first[i] : words.first[i + 1]], np.array([0, counts[i]]), int(counts[i]))[1][0] for i in short]
        found, owner = np.concatenate([found, np.array(extra, np.uint64)]), np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.concatenate([[True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])])[: len(found)]
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(texts) + 1))


def signatures(found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16 bits of each min-hash of each text with shingles: texts x (TREES * DEPTH)."""
    full = np.flatnonzero(np.diff(first))
    least = np.empty((len(full), len(_FACTORS)), "<u2")
    for i, (factor, offset) in enumerate(zip(_FACTORS, _OFFSETS)):
        lowest = np.minimum.reduceat(found * factor ^ offset, first[full]) if len(full) else found
        least[:, i] = mix(lowest) >> np.uint64(48)
    return least


def sign_texts(texts: DataFrame) -> DataFrame:
    """id, copies, shingles (their number) and signature (empty without words) of each text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, first = shingles(raw(batch.column("text")))
            counts = np.diff(first)
            signed = iter(signatures(found, first))
            rows = [next(signed).tobytes() if n else b"" for n in counts]
            columns = [batch.column("id"), batch.column("copies"), pa.array(counts, pa.int64()), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "copies", "shingles", "signature"])

    return texts.mapInArrow(sign, "id binary, copies long, shingles long, signature binary")


def prefixes(signed: DataFrame, depth: int) -> DataFrame:
    """prefix and number of each text and tree: a hash of the tree and its first hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(-1, TREES, DEPTH)
            keys = np.broadcast_to(np.arange(TREES, dtype=np.uint64), table.shape[:2])
            for i in range(depth):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + table[:, :, i].astype(np.uint64) + np.uint64(1))
            numbers = np.repeat(np.array(batch.column("number"), np.int64), TREES)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(numbers)], names=["prefix", "number"])

    return signed.where("shingles > 0").select("number", "signature").mapInArrow(cut, "prefix long, number long")


def block_members(signed: DataFrame, depth: int, chunk_shingles: int, chunk_texts: int) -> DataFrame:
    """id, block, low, high (a pair of chunks), chunk and blocks (all of the text's) of the
    texts that share a prefix with another."""
    keys = prefixes(signed, depth)
    shared = keys.groupBy("prefix").agg(F.min("number").alias("block"), F.count("*").alias("n")).where("n > 1")
    stars = saved(keys.join(shared, "prefix").select("block", "number").distinct(), "stars")
    numbers = signed.select("number", "id", "shingles")
    own = stars.groupBy("number").agg(F.collect_set("block").alias("blocks"))  # TREES at most
    chunks = F.greatest(F.ceil(F.sum("shingles") / chunk_shingles), F.ceil(F.count("*") / chunk_texts)).alias("chunks")
    # saved, as only a join of two plain shuffles lets Spark split a hot block
    sizes = saved(stars.join(numbers.drop("id"), "number").groupBy("block").agg(chunks), "sizes")
    placed = stars.join(own.join(numbers, "number"), "number").join(sizes, "block").withColumn("chunk", F.pmod(F.xxhash64("number"), "chunks"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    return paired.select("id", "number", "block", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "blocks")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sorted sets.

    Values of few sets are counted pair by pair, values of many by a matrix product of their
    incidence, a thousand columns at a time."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(values) for values in sets])
    order = np.argsort(np.concatenate(sets), kind="stable")  # keeps owners in order within a value
    values, owner = np.concatenate(sets)[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    counts = np.diff(np.append(first, len(values)))
    common = np.zeros((n, n), np.int32)
    for size in range(2, min(n, 16) + 1):
        members = owner[first[counts == size][:, None] + np.arange(size)]
        for a in range(size):
            for b in range(a + 1, size):
                np.add.at(common, (members[:, a], members[:, b]), 1)
    wide = np.flatnonzero(counts > 16)
    for part in np.array_split(wide, len(wide) // 1024 + 1) if len(wide) else []:
        incidence = np.zeros((n, len(part)), np.float32)
        for column, value in enumerate(part):
            incidence[owner[first[value] : first[value] + counts[value]], column] = 1
        common += np.triu((incidence @ incidence.T).astype(np.int32), 1)
    return common


def find_links(rows: dict[str, list], block: int, depth: int) -> dict[str, np.ndarray] | None:
    """Links of one pair of chunks: per text its number of linked documents, the least text
    it hangs together with, the links counted at it, and how many such links there are for
    each one found.

    A link found in several blocks counts in the first block that both texts are in."""
    sets = [np.frombuffer(values, np.uint64) for values in rows["set"]]
    n, sizes = len(sets), np.array([len(values) for values in sets], np.int32)
    if n < 2:
        return None
    common = intersections(sets)
    a, b = np.nonzero(np.triu(5 * common >= NEAR * (sizes[:, None] + sizes[None, :] - common), 1))
    chunk = np.array(rows["chunk"])
    if rows["low"][0] != rows["high"][0]:
        across = chunk[a] != chunk[b]
        a, b = a[across], b[across]
    earlier = sorted({other for blocks in rows["blocks"] for other in blocks if other < block})
    if earlier and len(a):
        place = {other: i for i, other in enumerate(earlier)}
        inside = np.zeros((n, len(earlier)), np.float32)
        for i, blocks in enumerate(rows["blocks"]):
            inside[i, [place[other] for other in blocks if other < block]] = 1
        new = ~((inside @ inside.T)[a, b] > 0)
        a, b = a[new], b[new]
    if not len(a):
        return None
    numbers, copies = np.array(rows["number"], np.int64), np.array(rows["copies"], np.int64)
    links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
    similarity = common[a, b] / (sizes[a] + sizes[b] - common[a, b])
    chance = 1 - (1 - similarity**depth) ** TREES
    root = numbers.copy()
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        if (root == before).all():
            break
    linked = links > 0
    found = {"number": numbers, "links": links.astype(np.int64), "root": root, "found": np.bincount(a, minlength=n), "expected": np.bincount(a, 1 / chance, n)}
    return {name: values[linked] for name, values in found.items()}


def verified_links(texts: DataFrame, members: DataFrame, depth: int) -> DataFrame:
    """number, links, root, found, expected of the texts with links, per pair of chunks."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, first = shingles(raw(batch.column("text")))
            sets = [found[start:end].tobytes() for start, end in zip(first, first[1:])]
            kept = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in kept], pa.array(sets, pa.binary())], names=[*kept, "set"])

    columns = "copies long, number long, tasks array<struct<block:long,low:long,high:long,chunk:long>>, blocks array<long>, set binary"
    once = members.groupBy("id").agg(
        F.first("number").alias("number"), F.collect_list(F.struct("block", "low", "high", "chunk")).alias("tasks"), F.first("blocks").alias("blocks")
    )
    shingled = texts.join(once, "id").select("copies", "text", "number", "tasks", "blocks").mapInArrow(shingle, columns)
    rows = shingled.select("number", "copies", "blocks", "set", F.explode("tasks").alias("task")).select("number", "copies", "blocks", "set", "task.*")
    group = ["block", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        current = None
        for batch in slices(batches, "set"):
            given = batch.to_pydict()
            keys = list(zip(*(given[name] for name in group)))
            edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for start, end in zip(edges, edges[1:]):
                if end == start:
                    continue
                if keys[start] != current:
                    yield from _answer(held, current, depth)
                    held, current = {name: [] for name in given}, keys[start]
                for name, values in given.items():
                    held[name].extend(values[start:end])
        yield from _answer(held, current, depth)

    return rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(
        compare, "number long, links long, root long, found long, expected double"
    )


def _answer(held: dict[str, list], current: tuple | None, depth: int) -> Iterator[pa.RecordBatch]:
    found = find_links(held, current[0], depth) if current else None
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(values) for values in found.values()], names=list(found))


def components(edges: DataFrame) -> DataFrame:
    """number and class (the least number of its component) of the ends of `edges`
    (number, root): each takes the least class around it, then its class's class, until
    nothing changes. Only minima are gathered at a text, whatever its number of edges."""
    both = saved(edges.unionByName(edges.select(F.col("root").alias("number"), F.col("number").alias("root"))).distinct(), "edges")
    labels = saved(both.groupBy("number").agg(F.least("number", F.min("root")).alias("class")), "classes")
    while True:
        around = both.join(labels.select(F.col("number").alias("root"), "class"), "root").groupBy("number").agg(F.min("class").alias("near"))
        least = labels.join(around, "number").select("number", F.col("class").alias("old"), F.least("class", "near").alias("class"))
        jumped = least.join(least.select(F.col("number").alias("class"), F.col("class").alias("far")), "class")
        changed = saved(jumped.select("number", F.least("class", "far").alias("class"), (F.least("class", "far") < F.col("old")).alias("moved")), "classes")
        labels = changed.select("number", "class")
        if changed.where("moved").isEmpty():
            return labels


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL, chunk_shingles: int = CHUNK_SHINGLES, chunk_texts: int = CHUNK_TEXTS) -> DataFrame:
    """`docs` with class_id, class_no and n_links in place of columns of those names.

    Rows are linked if their texts are equal or their sets of five-word shingles have a
    Jaccard similarity of 0.8 or more. n_links counts the other rows linked to a row,
    class_no numbers the component of linked rows, class_id is its least `key` (null if all
    keys are null). Texts are compared as words; a text of one to four words has one shingle;
    a null or empty text, or one of white space, is linked to equal texts only (null being empty).

    Equal texts are one text with copies, so copies are never paired. Rows of a hot prefix
    or block are spread over chunk pairs; what is emitted is per text, not per link."""
    texts = distinct_texts(docs, text)
    signed = saved(sign_texts(texts).withColumn("number", F.monotonically_increasing_id()), "signatures")
    for depth in range(DEPTH, 0, -1):
        members = block_members(signed, depth, chunk_shingles, chunk_texts)
        links = saved(verified_links(texts, members, depth), "links")
        sums = links.agg(F.sum("found").alias("found"), F.sum("expected").alias("expected")).first()
        weakest = 1 - (1 - (NEAR / 5) ** depth) ** TREES  # strong links are many, but may not hide weak ones
        if weakest >= recall and (not sums.found or sums.found >= recall * sums.expected):
            break
    counted = links.groupBy("number").agg(F.sum("links").alias("links"))
    classes = components(links.where("root <> number").select("number", "root"))
    names = [name for name in docs.columns if name not in ("class_id", "class_no", "n_links")]
    id_ = unused(names, "id")
    numbered = signed.select(F.col("id").alias(id_), "number", "copies").join(counted, "number", "left").join(classes, "number", "left")
    per_text = numbered.select(
        id_,
        F.coalesce("class", "number").alias("class_no"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    rows = docs.select(*names, text_id(text).alias(id_))
    least = rows.select(key, id_).join(per_text, id_).groupBy("class_no").agg(F.min(key).alias("class_id"))
    return rows.join(per_text.join(least, "class_no"), id_).select(*names, "class_id", "class_no", "n_links")


def document_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key`, class_id, n_links."""
    return near_copies(docs, key, text).select(key, "class_id", "n_links")
