"""How far the words of a language's sources are from each other (operator 13).

Arrow compute kernels inside tasks make lower case, split at everything that is no letter,
number the terms by a dictionary and count them by hash groups; a task sends each
(language, source, term) once for a few megabytes of text. Spark deals these partial counts
out by language and term, so that a term's counts of all sources meet, and the tasks merge
them into columnar shards: one row holds some thousand whole terms of a language with the
counts by source. Terms in too few documents go here. The shards are saved; their totals
give every group's size, and with these the shards compute their parts of the divergences:
sums for each pair of sources, and the best terms of each source. Parts of all tasks are
added up, or ranked, by Spark. All numbers are whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rolecast.llm.texts import slices
from rolecast.operators.lookups import lookup_join
from rolecast.session import saved

MIN_DOCS, TOP, SMOOTH, SCALE = 30, 50, 5, 10**9
#: What terms are cut at, after ASCII letters are made small. Arrow's engine reads it as UTF-8.
NO_LETTERS = r"[\x00-\x60\x7B-\x7F]+"
#: Text bytes that are counted at once; partial counts that a task holds before it sends them.
COUNT_BYTES, HELD_COUNTS = 4_000_000, 1_000_000
#: Partial counts that become one shard, and cells of a block of (source, term) or (source, source).
SHARD_COUNTS, BLOCK_CELLS = 100_000, 1 << 20
#: Sources in a block of pairs.
BLOCK_SOURCES = 512
#: Blocks of pair sums and groups of best terms that a task holds.
HELD_BLOCKS, HELD_GROUPS = 16, 20_000

COUNTS = "lang string, source string, term string, n long, docs long"
SHARDS = "lang string, terms array<string>, term_no array<int>, source_no array<int>, counts array<long>, sources array<string>, sums array<long>"
FOUND = "lang string, source string, part string, item string, value long"


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: occurrences and documents of each (lang, source, term) of a task's texts."""
    held, n_held = [], 0
    for batch in slices(batches, "text", COUNT_BYTES):
        held.append(_counted(batch))
        n_held += len(held[-1])
        if n_held >= HELD_COUNTS:
            merged = _add(held)
            held, n_held = [], 0
            if len(merged) < HELD_COUNTS // 2:  # most were equal
                held, n_held = [merged], len(merged)
            else:
                yield from merged.to_batches(max_chunksize=HELD_COUNTS)
    if held:
        yield from _add(held).to_batches(max_chunksize=HELD_COUNTS)


def _counted(batch: pa.RecordBatch) -> pa.Table:
    texts = batch.column("text").take(pa.array(np.arange(len(batch)))).cast(pa.large_string())  # a copy: ascii_lower mistakes a slice's place
    words = pc.split_pattern_regex(pc.ascii_lower(texts), NO_LETTERS)
    doc = pc.list_parent_indices(words)
    term = pc.list_flatten(words).dictionary_encode()
    table = pa.table({"doc": doc, "term": term.indices})
    empty = pc.index_in(pa.scalar("", pa.large_string()), term.dictionary).as_py()
    if empty is not None:  # before, after and between cuts
        table = table.filter(pc.not_equal(table["term"], empty))
    of_doc = table.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    langs, sources = (batch.column(name).dictionary_encode() for name in ("lang", "source"))
    n_sources = max(1, len(sources.dictionary))
    group = pc.add(pc.multiply(langs.indices.cast(pa.int64()), n_sources), sources.indices.cast(pa.int64()))
    of_group = pa.table({"group": group.take(of_doc["doc"]), "term": of_doc["term"], "n": of_doc["count_all"]})
    counts = of_group.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    number = counts["group"].to_numpy()
    return pa.table(
        {
            "lang": langs.dictionary.take(pa.array(number // n_sources)),
            "source": sources.dictionary.take(pa.array(number % n_sources)),
            "term": term.dictionary.take(counts["term"].combine_chunks()).cast(pa.string()),
            "n": counts["n_sum"],
            "docs": counts["count_all"],
        }
    )


def _add(tables: list[pa.Table]) -> pa.Table:
    """Counts of equal (lang, source, term) as one row."""
    keys = ["lang", "source", "term"]
    added = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return added.select([*keys, "n_sum", "docs_sum"]).rename_columns([*keys, "n", "docs"])


def merge_terms(min_docs: int):
    """Partial counts, sorted by language and term, become shards of whole terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.schema([(name, kind) for name, kind in zip(COUNT_NAMES, [pa.string()] * 3 + [pa.int64()] * 2)]).empty_table()
        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch]).cast(held.schema)])
            if len(held) >= SHARD_COUNTS:
                last = held.slice(len(held) - 1)
                same = pc.and_(pc.equal(held["lang"], last["lang"][0]), pc.equal(held["term"], last["term"][0]))
                whole = len(held) - pc.sum(same).as_py()  # the last term may go on
                yield from _shards(held.slice(0, whole), min_docs)
                held = _add([held.slice(whole)])
        yield from _shards(held, min_docs)

    return run


COUNT_NAMES = [part.split()[0] for part in COUNTS.split(", ")]
SHARD_NAMES = [part.split()[0] for part in SHARDS.split(", ")]


def _shards(counts: pa.Table, min_docs: int) -> Iterator[pa.RecordBatch]:
    if not len(counts):
        return
    counts = _add([counts])
    docs = counts.group_by(["lang", "term"], use_threads=False).aggregate([("docs", "sum")])
    often = docs.filter(pc.greater_equal(docs["docs_sum"], min_docs)).select(["lang", "term"])
    kept = counts.join(often, ["lang", "term"], join_type="inner", use_threads=False)
    for lang in pc.unique(kept["lang"]).to_pylist():
        rows = kept.filter(pc.equal(kept["lang"], lang))
        terms = rows["term"].combine_chunks().dictionary_encode()
        sources = rows["source"].combine_chunks().dictionary_encode()
        n = rows["n"].to_numpy()
        sums = np.zeros(len(sources.dictionary), np.int64)
        np.add.at(sums, sources.indices.to_numpy(), n)
        cells = [terms.dictionary, terms.indices, sources.indices, pa.array(n), sources.dictionary, pa.array(sums)]
        yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), *[_one_list(cell) for cell in cells]], names=SHARD_NAMES)


def _one_list(column: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def chances(counts: np.ndarray, total: np.ndarray, n_terms: int) -> np.ndarray:
    """1 + floor(10**9 * (counts + 5) / (total + 5 * n_terms)), by long division in three
    steps of 1,000, so that numbers stay in 63 bits for totals under 9 * 10**15."""
    below = np.asarray(total, np.int64) + SMOOTH * n_terms
    rest, found = counts.astype(np.int64) + SMOOTH, np.zeros(np.broadcast_shapes(np.shape(counts), np.shape(below)), np.int64)
    whole, rest = np.divmod(rest, below)  # a single term may be everything: then 1
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        found = found * 1000 + digit
    return 1 + whole * SCALE + found


class PairSums:
    """Sums for pairs of sources of a language, by blocks of sources; few blocks are held."""

    def __init__(self):
        self.sums: dict[tuple, np.ndarray] = {}
        self.sources: dict[str, list[str]] = {}

    def add(self, lang: str, sources: list[str], first: int, a: np.ndarray, second: int, b: np.ndarray) -> None:
        """`a[source, term]` and `b` of some terms, for the sources from `first` and `second` on."""
        self.sources[lang] = sources
        sums = self.sums.setdefault((lang, first, second), np.zeros((len(a), len(b)), np.int64))
        for i in range(len(a)):
            sums[i] += np.abs(a[i] - b).sum(axis=1)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for (lang, first, second), sums in self.sums.items():
            i, j = np.nonzero(np.arange(first, first + sums.shape[0])[:, None] < np.arange(second, second + sums.shape[1]))
            names = pa.array(self.sources[lang], pa.string())
            yield _found(lang, names.take(pa.array(first + i)), "pair", names.take(pa.array(second + j)), sums[i, j])
        self.sums.clear()
        self.sources.clear()


def _found(lang: str, sources: pa.Array, part: str, items: pa.Array, values: np.ndarray) -> pa.RecordBatch:
    n = len(values)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), sources, pa.array([part] * n, pa.string()), items, pa.array(values, pa.int64())],
        names=["lang", "source", "part", "item", "value"],
    )


class BestTerms:
    """The first terms of each group by value and name; an exact top of tops."""

    def __init__(self, top: int):
        self.top, self.best = top, {}

    def add(self, lang: str, source: str, terms: list[bytes], values: np.ndarray) -> None:
        rows = [*self.best.get((lang, source), ()), *zip((-values).tolist(), terms)]
        self.best[lang, source] = sorted(rows)[: self.top]

    def rows(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), rows in self.best.items():
            items = pa.array([term.decode() for _, term in rows], pa.string())
            yield _found(lang, pa.array([source] * len(rows), pa.string()), "term", items, -np.array([value for value, _ in rows], np.int64))
        self.best.clear()


def diverge(top: int):
    """Shards with their language's totals become parts of divergences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, best = PairSums(), BestTerms(top)
        for batch in batches:
            for i in range(len(batch)):
                cell = {name: batch.column(name)[i] for name in batch.schema.names}
                yield from _diverge_shard(cell, pairs, best)
                if len(pairs.sums) > HELD_BLOCKS:
                    yield from pairs.rows()
                if len(best.best) > HELD_GROUPS:
                    yield from best.rows()
        yield from pairs.rows()
        yield from best.rows()

    return run


def _diverge_shard(cell: dict, pairs: PairSums, best: BestTerms) -> Iterator[pa.RecordBatch]:
    lang, n_terms = cell["lang"].as_py(), cell["n_terms"].as_py()
    groups = cell["groups"].as_py()  # all sources of the language, with their totals
    sources, totals = [group["source"] for group in groups], np.array([group["total"] for group in groups], np.int64)
    own = pc.index_in(pa.array(cell["sources"].as_py(), pa.string()), pa.array(sources, pa.string())).to_numpy()
    terms = cell["terms"].values
    term, source, counts = cell["term_no"].values.to_numpy(), cell["source_no"].values.to_numpy(), cell["counts"].values.to_numpy()
    source = own[source] if len(source) else source
    order = np.argsort(term, kind="stable")
    term, source, counts = term[order], source[order], counts[order]
    all_counts = np.zeros(len(terms), np.int64)
    np.add.at(all_counts, term, counts)
    # terms that a source has more often than its language
    if len(counts):
        p, q = chances(counts, totals[source], n_terms), chances(all_counts, totals.sum(), n_terms)[term]
        over = np.flatnonzero((p > q) & (counts > 0))
        names = terms.cast(pa.binary())
        by_source = over[np.argsort(source[over], kind="stable")]
        edges = np.flatnonzero(np.diff(source[by_source])) + 1
        for rows in np.split(by_source, edges):
            if len(rows):
                values = (p - q)[rows]
                if len(rows) > 2 * best.top:  # only those that can be among the first
                    least = np.partition(values, len(values) - best.top)[len(values) - best.top]
                    rows, values = rows[values >= least], values[values >= least]
                best.add(lang, sources[source[rows[0]]], names.take(pa.array(term[rows])).to_pylist(), values)
    # pairs of sources, a block of terms at a time
    zero = chances(np.zeros(len(sources), np.int64), totals, n_terms) if n_terms else np.zeros(len(sources), np.int64)
    step = max(1, BLOCK_CELLS // max(1, len(sources)))
    starts = range(0, len(sources), BLOCK_SOURCES)
    for at in range(0, max(1, len(terms)), step):
        width = min(step, len(terms) - at)
        low, high = np.searchsorted(term, [at, at + width])
        blocks = {}
        for first in starts:
            p = np.repeat(zero[first : first + BLOCK_SOURCES, None], width, axis=1)
            mine = np.flatnonzero((source[low:high] >= first) & (source[low:high] < first + BLOCK_SOURCES)) + low
            if len(mine):
                p[source[mine] - first, term[mine] - at] = chances(counts[mine], totals[source[mine]], n_terms)
            blocks[first] = p
        for first in starts:
            for second in starts:
                if first <= second:
                    pairs.add(lang, sources, first, blocks[first], second, blocks[second])
                    if len(pairs.sums) > HELD_BLOCKS:
                        yield from pairs.rows()


def source_divergence(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """For each (lang, source): lang, source, part, item, value, rank.

    Part `pair` has the distance to every other source of the language, `term` the first
    `top` terms that the source has more often than its language. Null texts, languages and
    sources are empty; a source without terms has its pairs; equal values go by the bytes of
    the item; repeated rows are documents like others; very long texts are counted whole, as
    a batch of their own; an empty table gives no rows; other columns are not read.

    A language with S sources has S * (S - 1) rows of pairs; its list of sources goes to the
    tasks with its shards, broadcast only if all lists together are measured to be small."""
    given = docs.select(*[F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name) for column, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    partial = given.mapInArrow(count_terms, COUNTS)
    met = partial.repartition("lang", "term").sortWithinPartitions("lang", "term")
    shards = saved(met.mapInArrow(merge_terms(min_docs), SHARDS), "term-shards")
    sums = shards.select("lang", F.explode(F.arrays_zip("sources", "sums")).alias("of")).groupBy("lang", F.col("of.sources").alias("source"))
    groups = given.select("lang", "source").distinct().join(sums.agg(F.sum("of.sums").alias("total")), ["lang", "source"], "left")
    every = F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).cast("long").alias("total")))).alias("groups")
    sizes = shards.groupBy("lang").agg(F.sum(F.size("terms")).alias("n_terms"))
    languages = saved(groups.groupBy("lang").agg(every).join(sizes, "lang", "left").fillna(0, ["n_terms"]), "languages")
    empty = languages.select("lang", *[F.array().cast(shards.schema[name].dataType).alias(name) for name in SHARD_NAMES[1:]])
    whole = lookup_join(shards.unionByName(empty), languages, "lang", ["terms"], "inner")  # an empty shard has all pairs of its language
    found = saved(whole.mapInArrow(diverge(top), FOUND), "divergence-parts")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("way")
    both = pairs.select("lang", ways, "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = both.unionByName(found.where("part = 'term'")).withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top)).select(
        F.col("lang").alias(lang), F.col("source").alias(source), "part", "item", "value", "rank"
    )


def divergence_sql(min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """The same for a table `documents` in DuckDB."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
with docs as (select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (
    select d, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), '{capitals}', '{capitals.lower()}') as term
    from docs
),
kept as materialized (select lang, term from words group by lang, term having count(distinct d) >= {min_docs}),
groups as (select distinct lang, source from docs),
counts as (select lang, source, term, count(*) as n from words group by lang, source, term),
cells as materialized (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as n
    from groups g join kept k on k.lang = g.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
),
by_source as materialized (
    select *, 1 + {SCALE}::hugeint * (n + {SMOOTH}) // (sum(n) over (partition by lang, source) + {SMOOTH} * count(*) over (partition by lang, source)) as p from cells
),
by_lang as (
    select lang, term, 1 + {SCALE}::hugeint * (n + {SMOOTH}) // (sum(n) over (partition by lang) + {SMOOTH} * count(*) over (partition by lang)) as q
    from (select lang, term, sum(n) as n from cells group by lang, term)
),
found as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum(abs(a.p - b.p)), 0) as value
    from by_source a join by_source b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
    union all
    select a.lang, a.source, 'pair', b.source, 0 from groups a join groups b on a.lang = b.lang and a.source <> b.source
    where a.lang not in (select lang from kept)
    union all
    select lang, source, 'term', term, p - q from by_source join by_lang using (lang, term) where n > 0 and p > q
),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found)
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked where part = 'pair' or rank <= {top}"""
