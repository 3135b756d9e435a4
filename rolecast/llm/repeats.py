"""Exact removal of repeated passages (operator 6): FM-index shards of candidate fragments.

A window is `width` consecutive words. Each window is dealt out by its anchor, the least hash
of its groups of ANCHOR words: equal windows have equal anchors, so they meet in one shard.
Neighbouring windows with the anchor at the same place travel as one fragment, and only
fragments whose anchor occurs twice or more travel at all. A shard builds an FM-index of its
distinct fragments, weighted by their copies, and streams the fragments through it."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolecast.llm.fm_index import WordIndex
from rolecast.llm.texts import Words, raw, slices, span_hashes, unused, window_hashes
from rolecast.session import new_path, saved

WIDTH = 35
ANCHOR = 12
#: Words of the fragments of one shard, on average.
SHARD_WORDS = 1_000_000
#: Words of one index; a task with more shards' worth of one anchor than planned builds the
#: index it needs, since an anchor with more fragments than this is dealt out by windows.
HOT_FRAGMENTS = 10_000


def text_id(text: str):
    """Identity of a text; null is empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """id, copies and text of each distinct text, bucketed by id in the shared folder, so
    that later joins by id do not move the texts again."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.select(text_id(text).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    grouped = found.groupBy("id").agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    name = f"texts_{uuid.uuid4().hex}"
    writer = grouped.write.bucketBy(buckets, "id").option("compression", "zstd").option("path", new_path(spark, "texts"))
    writer.format("parquet").saveAsTable(name)
    return spark.table(name)


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value of each run of `width` values, the leftmost of equals."""
    best, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:-step], best[step:]
        best = np.where(values[left] <= values[right], left, right)
        span += step
    return best


def fragments_of(words: Words, width: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Text, first word (in the text), number of windows, anchor and content hash of each
    fragment."""
    hashes = words.hashes()
    starts, groups = window_hashes(hashes, words.first, anchor)
    text_of = np.searchsorted(words.first, starts, side="right") - 1
    per_window = width - anchor + 1
    if len(groups) < per_window:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty
    least = _leftmost_least(groups, per_window)
    whole = text_of[: len(least)] == text_of[per_window - 1 :]  # windows inside one text
    at, least = np.flatnonzero(whole), least[whole]
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (np.diff(at) != 1)])[: len(at)]
    begin = np.flatnonzero(new)
    counts = np.diff(np.append(begin, len(at)))
    owner, first = text_of[at[begin]], starts[at[begin]]
    content = span_hashes(hashes, first, first + counts + width - 1)
    return owner, first - words.first[owner], counts, groups[least[begin]].view(np.int64), content.view(np.int64)


def find_fragments(texts: DataFrame, width: int, anchor: int) -> DataFrame:
    """id, copies, anchor, first, windows, content of all fragments."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, first, windows, anchors, content = fragments_of(Words(raw(batch.column("text"))), width, anchor)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(rows),
                    batch.column("copies").take(rows),
                    pa.array(anchors, pa.int64()),
                    pa.array(first, pa.int32()),
                    pa.array(windows, pa.int32()),
                    pa.array(content, pa.int64()),
                ],
                names=["id", "copies", "anchor", "first", "windows", "content"],
            )

    return texts.mapInArrow(find, "id binary, copies long, anchor long, first int, windows int, content long")


def _flat(lists: pa.ListArray, *names: str) -> list[np.ndarray]:
    """Row of each element of a column of lists of structs, and the named fields."""
    elements = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), np.array(pc.fill_null(pc.list_value_length(lists), 0), np.int64))
    return [owner, *(elements.field(name).to_numpy(zero_copy_only=False) for name in names)]


def cut_fragments(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """id, route, digest, first, copies and words (null where the task gave them before) of
    the wanted fragments; those of hot anchors are cut into their windows, dealt out by
    the content of the window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[bytes] = set()
        for batch in slices(batches):
            # with single spaces, a fragment is a stretch of the text's bytes
            words = Words([b" ".join(text.split()) for text in raw(batch.column("text"))])
            text, first, windows, anchor, hot = _flat(batch.column("wanted"), "first", "windows", "anchor", "hot")
            pieces = np.where(hot, windows, 1)  # windows of their own, if hot
            piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            text, first, anchor, hot = (np.repeat(values, pieces) for values in (text, first, anchor, hot))
            windows = np.where(hot, 1, np.repeat(windows, pieces))
            first = first + piece
            begin = words.first[text] + first
            route = anchor.copy()
            if hot.any():
                route[hot] = span_hashes(words.hashes(), begin[hot], begin[hot] + width).view(np.int64)
            data = words.data.tobytes()
            content = [data[i:j] for i, j in zip(words.starts[begin].tolist(), words.ends[begin + windows + width - 2].tolist())]
            digests = [hashlib.md5(each).digest() for each in content]
            fresh = [None if digest in given else given.add(digest) or each for digest, each in zip(digests, content)]
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(rows),
                    pa.array(route, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(first, pa.int32()),
                    batch.column("copies").take(rows),
                    pa.array(fresh, pa.binary()),
                ],
                names=["id", "route", "digest", "first", "copies", "words"],
            )

    found = texts.join(wanted, "id").select("id", "copies", "text", "wanted")
    return found.mapInArrow(cut, "id binary, route long, digest binary, first int, copies long, words binary")


def repeated_in_shards(fragments: DataFrame, shards: int, width: int) -> DataFrame:
    """route, digest and windows (bit i: the window that starts at word i of the fragment
    occurs elsewhere) of distinct fragments, from one FM-index per shard."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: dict[str, list] = {"route": [], "digest": [], "copies": [], "words": []}
        for batch in batches:
            for name, values in columns.items():
                values.extend(batch.column(name).to_pylist())
        if not columns["route"]:
            return
        index = WordIndex([words.split(b" ") for words in columns["words"]], np.array(columns["copies"], np.int64), width)
        fragment, start = index.repeated()
        masks = np.zeros(len(columns["route"]), np.int64)
        np.bitwise_or.at(masks, fragment, np.int64(1) << start)
        kept = np.flatnonzero(masks)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([columns["route"][i] for i in kept], pa.int64()),
                pa.array([columns["digest"][i] for i in kept], pa.binary()),
                pa.array(masks[kept], pa.int64()),
            ],
            names=["route", "digest", "windows"],
        )

    dealt = fragments.select("route", "digest", "copies", "words").repartition(shards, "route")
    return dealt.mapInArrow(search, "route long, digest binary, windows long")


def remove_words(texts: DataFrame, repeated: DataFrame, width: int) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 and kept (null if all words stay) of each text."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            split = [text.split() for text in raw(batch.column("text"))]
            sizes = np.array([len(words) for words in split], np.int64)
            base = np.cumsum(sizes + 1) - sizes - 1
            covered = np.zeros(int((sizes + 1).sum()) + 1, np.int64)
            text, first, windows = _flat(batch.column("marks"), "first", "windows")
            for bit in range(int(windows.max()).bit_length() if len(windows) else 0):
                at = (base[text] + first + bit)[windows >> bit & 1 == 1]
                np.add.at(covered, at, 1)
                np.add.at(covered, at + width, -1)
            stays = np.cumsum(covered) == 0
            kept = [list(compress(words, stays[i : i + len(words)].tolist())) for words, i in zip(split, base.tolist())]
            texts = [b" ".join(words) for words in kept]
            removed = sizes - np.array([len(words) for words in kept], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([hashlib.sha256(words).hexdigest() for words in texts], pa.string()),
                    pa.array([words.decode() if n else None for words, n in zip(texts, removed.tolist())], pa.string()),
                ],
                names=["id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    marks = repeated.groupBy("id").agg(F.collect_list(F.struct("first", "windows")).alias("marks"))  # within one text
    rows = texts.join(marks, "id", "left").select("id", "text", "marks")
    return rows.mapInArrow(remove, "id binary, n_words long, n_removed long, kept_sha256 string, kept string")


def remove_repeats(docs: DataFrame, text: str = "text", width: int = WIDTH, anchor: int = ANCHOR, hot: int = HOT_FRAGMENTS) -> DataFrame:
    """`docs` with n_words, n_removed, kept_sha256 and kept_text in place of columns of those names.

    A word goes if a window of `width` words covers it whose word sequence also starts
    anywhere else in `docs`, in the same row too; all windows are judged on the input.
    Texts with equal words in all rows count as elsewhere for each other. kept_text is the
    text as it is if no word goes, else the kept words joined by one space. A null text has
    no words and stays null. Rows with null keys are rows like others.

    Equal texts are searched once, with their number as weight. Anchors are counted after
    partial sums, and joins by anchor leave a hot one to be split at run time. An anchor with
    more than `hot` fragments that differ is dealt out by whole windows, and equal fragments
    of a task are sent once, so no shard holds one passage's many contexts."""
    texts = distinct_texts(docs, text)
    found = saved(find_fragments(texts, width, min(anchor, width)), "fragments")
    counts = found.groupBy("anchor").agg(
        F.sum("copies").alias("n"), F.count("*").alias("texts"), F.min("content").alias("low"), F.max("content").alias("high")
    )
    # saved, as only a join of two plain shuffles lets Spark split a hot anchor
    twice = saved(counts.where("n > 1").select("anchor", F.expr(f"texts > {int(hot)} and low <> high").alias("hot")), "anchors")
    candidates = found.select("id", "anchor", "first", "windows").join(twice, "anchor")
    wanted = candidates.groupBy("id").agg(F.collect_list(F.struct("first", "windows", "anchor", "hot")).alias("wanted"))
    cut = saved(cut_fragments(texts, wanted, width), "cut")
    distinct = cut.groupBy("route", "digest").agg(F.sum("copies").alias("copies"), F.max("words").alias("words"))
    n_words = cut.agg(F.sum(F.octet_length("words")) / 6).first()[0] or 0  # about six bytes a word
    masks = saved(repeated_in_shards(distinct, int(n_words // SHARD_WORDS) + 1, width), "masks")
    repeated = cut.select("id", "route", "digest", "first").join(masks, ["route", "digest"])
    results = remove_words(texts, repeated.select("id", "first", "windows"), width)
    names = [name for name in docs.columns if name not in ("n_words", "n_removed", "kept_sha256", "kept_text")]
    id_, kept = unused(names, "id"), unused(names, "kept")
    rows = docs.select(*names, text_id(text).alias(id_))
    joined = rows.join(results.withColumnsRenamed({"id": id_, "kept": kept}), id_)
    return joined.select(*names, "n_words", "n_removed", "kept_sha256", F.coalesce(kept, text).alias("kept_text"))


def document_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key`, n_words, n_removed, kept_sha256."""
    return remove_repeats(docs.select(key, text), text).select(key, "n_words", "n_removed", "kept_sha256")
