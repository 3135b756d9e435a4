"""Benchmark passages in documents (operator 7): q-gram lemma in diagonal bands, then
banded alignment.

An item of n characters that occurs in a document with at most e edits shares at least
n - q + 1 - q * e of its q-grams with it, all on diagonals (place in the document less place
in the item) that differ by e at most. So shared q-grams are counted in overlapping bands of
diagonals, two steps of e + 1 wide, and only bands that reach the bound are aligned."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolecast.llm.texts import powers, raw, slices

Q = 8
#: Edits allowed: one in so many characters of the item.
CHARS_PER_EDIT = 10
#: Characters of items searched in one pass over the documents; more items, more passes.
BLOCK_CHARS = 8_000_000
#: Slots of the first test of a q-gram.
FILTER = 1 << 22


def normal(text: str) -> str:
    """Lower case, white space as single spaces."""
    return " ".join(text.lower().split())


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def gram_hashes(points: np.ndarray, q: int = Q) -> np.ndarray:
    """64-bit hashes of all q-grams of code points."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    up, down = powers(len(points) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)])])
    hashes = (sums[q:] - sums[:-q]) * down[: len(points) - q + 1]
    return (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def budget(length: int, q: int = Q) -> int:
    """Edits allowed in an item: its share, or what still leaves one shared q-gram."""
    return min(length // CHARS_PER_EDIT, (length - q) // q)


def fewest_edits(item: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int]:
    """Least edits that turn `item` into a stretch of `text` along diagonals low .. high, and
    the end of that stretch.

    Row i of the table holds, per diagonal d, the edits of the first i characters against a
    stretch that ends before text[i + d]; a stretch may start and end anywhere. Beyond the
    ends of the text stand characters that equal none: one of them costs as much as dropping
    the item's character, so they change no minimum."""
    width = high - low + 1
    around = np.full(len(item) + width, -1, np.int64)
    begin, end = max(low, 0), min(low + len(around), len(text))
    if begin < end:
        around[begin - low : end - low] = text[begin:end]
    steps = np.arange(width)
    row, best = np.zeros(width, np.int64), np.empty(width, np.int64)
    for i, char in enumerate(item.tolist()):
        np.add(row, around[i : i + width] != char, out=best)  # this character against the next of the text
        np.minimum(best[:-1], row[1:] + 1, out=best[:-1])  # the item's character has no partner
        best -= steps
        row = np.minimum.accumulate(best) + steps  # characters of the text without partner
    at = int(row.argmin())
    return int(row[at]), min(max(low + at + len(item), 0), len(text))


def _in_large_groups(owner: np.ndarray, band: np.ndarray, place: np.ndarray, needed: np.ndarray) -> tuple[np.ndarray, ...]:
    """The entries of (owner, band) groups with as many entries as they need."""
    span = int(band.max()) - int(band.min()) + 1 if len(band) else 1
    if len(owner) and (int(owner.max()) + 1) * span >= 1 << 62:
        return owner, band, place  # too many groups to number them so
    group = owner * span + (band - (band.min() if len(band) else 0))
    _, of, counts = np.unique(group, return_inverse=True, return_counts=True)
    large = counts[of] >= needed
    return owner[large], band[large], place[large]


@dataclass
class Items:
    """Normalised items of one pass and the places of their q-grams."""

    ids: list
    points: list[np.ndarray]
    edits: np.ndarray
    needed: np.ndarray  # shared q-grams in a band
    grams: np.ndarray  # sorted and distinct
    first: np.ndarray  # of the places of each q-gram
    item: np.ndarray
    place: np.ndarray
    present: np.ndarray  # FILTER slots

    @classmethod
    def build(cls, ids: list, texts: list[str]) -> Items:
        points = [points_of(normal(text)) for text in texts]
        sizes = np.array([len(each) for each in points], np.int64)
        edits = np.array([budget(size) for size in sizes], np.int64)
        hashes = [gram_hashes(each) for each in points]
        item = np.repeat(np.arange(len(ids)), [len(each) for each in hashes])
        place = np.concatenate([np.arange(len(each)) for each in hashes]) if hashes else np.zeros(0, np.int64)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        grams, first = np.unique(flat[order], return_index=True)
        present = np.zeros(FILTER, bool)
        present[grams >> np.uint64(42)] = True
        return cls(ids, points, edits, sizes - Q + 1 - Q * edits, grams, np.append(first, len(flat)), item[order], place[order], present)

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, end) of all occurrences, the best of each text and item."""
        spelled = [points_of(normal(text)) for text in texts]
        sizes = np.array([len(each) for each in spelled], np.int64)
        starts = np.cumsum(sizes) - sizes
        if not len(self.grams) or not sizes.sum():
            return []
        hashes = gram_hashes(np.concatenate(spelled))
        places = np.flatnonzero(self.present[hashes >> np.uint64(42)])
        rank = np.minimum(np.searchsorted(self.grams, hashes[places]), len(self.grams) - 1)
        known = self.grams[rank] == hashes[places]
        places, rank = places[known], rank[known]
        text = np.searchsorted(starts, places, side="right") - 1
        inside = places + Q <= starts[text] + sizes[text]
        places, rank, text = (places - starts[text])[inside], rank[inside], text[inside]
        counts = self.first[rank + 1] - self.first[rank]
        posting = np.repeat(self.first[rank] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        text, item = np.repeat(text, counts), self.item[posting]
        band = np.floor_divide(np.repeat(places, counts) - self.place[posting], self.edits[item] + 1)
        owner, band = np.tile(text * len(self.ids) + item, 2), np.concatenate([band, band - 1])
        place = np.tile(self.place[posting], 2)
        owner, band, place = _in_large_groups(owner, band, place, self.needed[owner % len(self.ids)])
        # a q-gram of the item counts once in a band, however often the text repeats it there
        order = np.lexsort((place, band, owner))
        owner, band, place = owner[order], band[order], place[order]
        new = np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(band) != 0)])[: len(owner)]
        other = new | np.concatenate([[True], np.diff(place) != 0])[: len(owner)]
        shared = np.bincount(np.cumsum(new) - 1, weights=other)
        owner, band = owner[new], band[new]
        reached = shared >= self.needed[owner % len(self.ids)]
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for owner, band in zip(owner[reached].tolist(), band[reached].tolist()):
            text, item = divmod(owner, len(self.ids))
            if found.get((text, item), (1, 0))[0] == 0:
                continue  # found without edits in the band before
            edits = int(self.edits[item])
            low = band * (edits + 1)  # the band holds low .. low + 2 * edits + 1; the path stays within `edits` of it
            best = fewest_edits(self.points[item], spelled[text], low - edits, low + 3 * edits + 1)
            if best[0] <= edits:
                found[text, item] = min(found.get((text, item), best), best)
        return [(text, item, *best) for (text, item), best in sorted(found.items())]


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of the items, in blocks of about BLOCK_CHARS characters, whose size is
    known before they reach the driver. Items too short for one q-gram are left out."""
    known = items.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null").distinct()
    total = known.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = total // BLOCK_CHARS + 1
    for block in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == block).orderBy("key", "text").collect()
        rows = [row for row in rows if len(normal(row.text)) >= Q]
        if rows:
            yield [row.key for row in rows], [row.text for row in rows]


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document row and item that occurs in it: `key`, `item_key`, n_edits (least
    edits of characters), end_char (end of that stretch).

    Both are compared in lower case with white space as single spaces; end_char counts in
    that form. Allowed are length / 10 edits, less for items under 80 characters, as one
    shared 8-gram must remain. Null texts and items, and items under 8 characters, give no
    rows; null keys stay null; repeated document rows each get their rows, repeated item rows
    one. Without items or documents there are no rows. The documents are read once per block of items."""
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text")).where("text is not null")
    kind, item_kind = rows.schema["key"].dataType, items.schema[item_key].dataType
    schema = f"`{key}` {kind.simpleString()}, `{item_key}` {item_kind.simpleString()}, n_edits long, end_char long"
    found = docs.sparkSession.createDataFrame([], schema)
    for ids, texts in item_blocks(items, item_key, item_text):
        found = found.unionByName(_search(rows, Items.build(ids, texts), schema, [key, item_key]))
    return found


def _search(rows: DataFrame, items: Items, schema: str, names: list[str]) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = items.search([value.decode() for value in raw(batch.column("text"))])
            if found:
                text, item, edits, end = zip(*found)
                columns = [
                    batch.column("key").take(pa.array(text)),
                    pa.array([items.ids[i] for i in item]),
                    pa.array(edits, pa.int64()),
                    pa.array(end, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_edits", "end_char"])

    return rows.mapInArrow(search, schema)
