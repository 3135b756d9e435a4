"""Language prediction by n-gram filters (operator 2).

The n-grams that are common enough in the labelled texts of a language go into that
language's Bloom filter. The filters have the same hash functions and are stored bit-sliced:
a slot holds one bit per language, so the AND of the few slots of an n-gram is the mask of
all languages that contain it. A text gets, for each language, the share of its n-grams with
that bit, less what false positives explain; the largest share decides."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecast.llm.texts import mix, raw, slices
from rolecast.session import saved

UNDECIDED = "und"
#: Letters of an n-gram; runs of other characters count as one space.
LETTERS = 4
#: An n-gram belongs to a language if this share of the language's n-grams is its own. At
#: most 1 / COMMON n-grams do, so the model's size has a bound.
COMMON = 1e-5
HASHES = 3
#: Slots per n-gram, before rounding up to a power of two.
SLOTS = 16
#: Languages per 64-bit word of a slot.
WORD = 63
#: Texts of a language that may have less than it usually has, and how much less is accepted.
OUTLIERS, LEAST_OF_USUAL = 0.01, 0.5
#: How far the share of a text may be off, times the root of its n-grams: three deviations.
SLACK = 1.5
#: Text bytes looked at together: an n-gram takes some hundred bytes of arrays.
PIECE_BYTES = 1_000_000

_ALPHABETIC: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _ALPHABETIC:
        _ALPHABETIC.append(np.array([chr(point).isalpha() for point in range(0x110000)]))
    return _ALPHABETIC[0]


def ngrams(texts: list[bytes], letters: int = LETTERS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the first one of each text (and the end), has-a-letter of each
    text. A space alone is no n-gram."""
    is_letter = _letters()
    # a text is lower-cased alone, as the case of a letter may depend on its neighbours
    spelled = [np.frombuffer(f" {text.decode().lower()} ".encode("utf-32-le"), "<u4") for text in texts]
    if not spelled:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, bool)
    sizes = np.array([len(points) for points in spelled], np.int64)
    points = np.concatenate(spelled)
    word = is_letter[points]
    points = np.where(word, points, 32)
    starts = np.zeros(len(points), bool)
    starts[np.cumsum(sizes) - sizes] = True
    kept = word | np.concatenate([[True], word[:-1]]) | starts
    text_of = np.repeat(np.arange(len(texts)), sizes)
    points, text_of = points[kept].astype(np.uint64), text_of[kept]
    width = min(letters, len(points))
    hashes = np.zeros(len(points) - width + 1, np.uint64)
    for i in range(width):
        hashes = hashes * np.uint64(0x100000001B3) + points[i : len(points) - width + 1 + i]
    inside = text_of[: len(hashes)] == text_of[width - 1 :]
    if letters == 1:
        inside &= points != 32
    # a text shorter than an n-gram has the n-gram that it is the start of
    short = np.flatnonzero(np.bincount(text_of, minlength=len(texts)) < letters)
    if len(short) and letters > 1:
        extra = [_padded(points[text_of == text], letters) for text in short]
        hashes = np.concatenate([hashes[inside], np.array(extra, np.uint64)])
        owner = np.concatenate([text_of[: len(inside)][inside], short])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    else:
        hashes, owner = hashes[inside], text_of[: len(inside)][inside]
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    has_letter = np.bincount(np.repeat(np.arange(len(texts)), sizes), weights=word, minlength=len(texts)) > 0
    return mix(hashes), first, has_letter


def _padded(points: np.ndarray, letters: int) -> int:
    value = 0
    for i in range(letters):
        value = (value * 0x100000001B3 + (int(points[i]) if i < len(points) else 32)) % 2**64
    return value


def slots_of(hashes: np.ndarray, slots: int) -> np.ndarray:
    """HASHES slots of each n-gram."""
    steps = mix(hashes ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return np.stack([((hashes + np.uint64(i) * steps) & np.uint64(slots - 1)).astype(np.int64) for i in range(HASHES)])


@dataclass
class LanguageModel:
    languages: list[str]  # the most frequent first: ties go to it
    table: np.ndarray  # slots x words
    letters: int = LETTERS  # of an n-gram

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """words x n-grams: the languages that contain each n-gram."""
        places = slots_of(hashes, len(self.table))
        found = self.table[places[0]]
        for row in places[1:]:
            found &= self.table[row]
        return found.T

    def false_positives(self) -> np.ndarray:
        """Chance that an n-gram of no filter is found in each language's."""
        bits = [(self.table[:, i // WORD] >> np.uint64(i % WORD)) & np.uint64(1) for i in range(len(self.languages))]
        return np.array([bit.mean() for bit in bits]) ** HASHES

    def shares(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """languages x texts: the share of a text's n-grams in each filter, less false
        positives; the number of n-grams and has-a-letter of each text."""
        hashes, first, has_letter = ngrams(texts, self.letters)
        counts, shares = np.diff(first), np.zeros((len(self.languages), len(texts)))
        if self.languages and len(texts):
            masks = self.masks(hashes)
            for i, chance in enumerate(self.false_positives()):
                hits = np.concatenate([[0], np.cumsum((masks[i // WORD] >> np.uint64(i % WORD)) & np.uint64(1), dtype=np.int64)])
                share = (hits[first[1:]] - hits[first[:-1]]) / np.maximum(counts, 1)
                shares[i] = np.clip((share - chance) / max(1 - chance, 1e-9), 0, 1)
        return shares, counts, has_letter

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        if not self.languages or not len(texts):
            return [UNDECIDED] * len(texts), np.zeros(len(texts))
        shares, _, has_letter = self.shares(texts)
        best = shares.argmax(axis=0)
        named = [self.languages[i] if letter else UNDECIDED for i, letter in zip(best, has_letter)]
        return named, np.where(has_letter, shares[best, np.arange(len(texts))], 0.0)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", letters: int = LETTERS) -> LanguageModel:
    """Fit the filters on all rows with a text and a language.

    n-grams are counted per task and language before they are shuffled, (task, language,
    n-gram) being one row whatever its count; a third of all rows with one language is no
    more than one language's rows. The driver receives the totals of the languages and the
    slots that are set, at most languages / COMMON * HASHES of them."""
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in slices(batches, limit=PIECE_BYTES):
            hashes, first, has_letter = ngrams(raw(batch.column("text")), letters)
            langs = np.array(batch.column("lang").to_pylist(), object)
            owner = np.repeat(np.where(has_letter, np.arange(len(langs)), -1), np.diff(first))
            for name in sorted(set(langs)):
                chosen = np.isin(owner, np.flatnonzero(langs == name))
                parts = held.setdefault(name, [])
                parts.append(np.unique(hashes[chosen], return_counts=True))
                if len(parts) > 16:
                    held[name] = [_merged(parts)]
        for name, parts in held.items():
            grams, counts = _merged(parts)
            columns = [pa.array([name] * len(grams)), pa.array(grams.view(np.int64)), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    labelled = docs.select(docs[text].alias("text"), docs[lang].alias("lang")).where("text is not null and lang is not null")
    partial = labelled.mapInArrow(count, "lang string, gram long, n long")
    counted = saved(partial.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "ngrams")
    totals = {row.lang: row.n for row in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals, key=lambda name: (-totals[name], name))
    known = spark.createDataFrame([(name, i, totals[name]) for i, name in enumerate(languages)], "lang string, place int, total long")
    common = counted.join(F.broadcast(known), "lang").where(F.col("n") >= F.col("total") * COMMON)
    grams = saved(common.select("gram", "place"), "common")
    slots = 1 << max(10, (SLOTS * grams.select("gram").distinct().count() - 1).bit_length())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.array(batch.column("place"), np.int64)
            bits = np.left_shift(np.int64(1), places % WORD)
            for row in slots_of(np.array(batch.column("gram"), np.int64).view(np.uint64), slots):
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(places // WORD), pa.array(bits)], names=["slot", "word", "bits"])

    filled = grams.mapInArrow(place, "slot long, word long, bits long").groupBy("slot", "word").agg(F.bit_or("bits").alias("bits"))
    rows = filled.toPandas()
    table = np.zeros((slots, -(-len(languages) // WORD) or 1), np.uint64)
    table[rows["slot"].to_numpy(np.int64), rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return LanguageModel(languages, table, letters)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and summed counts of several such pairs."""
    values, places = np.unique(np.concatenate([part[0] for part in parts]), return_inverse=True)
    weights = np.concatenate([part[1] for part in parts])
    return values, np.bincount(places, weights=weights, minlength=len(values)).astype(np.int64)


def predict_languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score (0 to 1); columns of these names are replaced.

    `und` with score 0 stands for a null text, one without a letter, and every text if the
    model knows no language. Ties go to the language with the most training n-grams."""
    names = [name for name in docs.columns if name not in ("lang_pred", "score")]
    schema = docs.select(*names).schema.add("lang_pred", "string").add("score", "double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, PIECE_BYTES):
            named, scores = model.predict(raw(batch.column(text)))
            columns = [*batch.columns, pa.array(named, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score"])

    return docs.select(*names).mapInArrow(predict, schema)


@dataclass
class Judge:
    """A model, and for each of its languages the least share that its own texts have."""

    model: LanguageModel
    least: np.ndarray

    def accepts(self, texts: list[bytes], slack: float = 0.0) -> np.ndarray:
        """languages x texts: whether a text has the least share. That of n n-grams is known
        to about 1 / sqrt(n); `slack` of these are let pass."""
        shares, counts, has_letter = self.model.shares(texts)
        return (shares >= self.least[:, None] - slack / np.sqrt(np.maximum(counts, 1))) & has_letter


def judge(model: LanguageModel, docs: DataFrame, text: str = "text", lang: str = "lang") -> Judge:
    """Find the least shares on labelled rows from which the model has not learned: half of
    what all but one in a hundred texts of a language have. A language without such rows has
    none. The driver receives a number per language."""
    names = {name: i for i, name in enumerate(model.languages)}

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=PIECE_BYTES):
            shares, _, has_letter = model.shares(raw(batch.column("text")))
            place = np.array([names.get(name, -1) for name in batch.column("lang").to_pylist()], np.int64)
            at = np.flatnonzero(has_letter & (place >= 0))
            yield pa.RecordBatch.from_arrays([pa.array(place[at], pa.int64()), pa.array(shares[place[at], at] if len(at) else [], pa.float64())], names=["place", "share"])

    labelled = docs.select(docs[text].alias("text"), docs[lang].alias("lang")).where("text is not null and lang is not null")
    found = labelled.mapInArrow(own, "place long, share double").groupBy("place").agg(F.percentile_approx("share", OUTLIERS, 10_000).alias("share"))
    least = np.zeros(len(model.languages))
    for row in found.collect():
        least[row["place"]] = LEAST_OF_USUAL * row["share"]
    return Judge(model, least)


def explained(docs: DataFrame, grams: Judge, letters: Judge, text: str = "text") -> DataFrame:
    """The rows of `docs` that may be of some language, by its n-grams and by its letters.

    A language with so many different n-grams that few are common says nothing by them, and
    a text of a few letters has too few; letters then decide. Null texts and those without a
    letter have no language, nor has one in letters that no language learned has."""
    schema = docs.schema
    places = [letters.model.languages.index(name) if name in letters.model.languages else -1 for name in grams.model.languages]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, PIECE_BYTES):
            texts = raw(batch.column(text))
            # a language whose own texts may have no n-gram in common accepts none by these alone
            kept = (grams.accepts(texts) & (grams.least > 0)[:, None]).any(axis=0)
            open_ = np.flatnonzero(~kept)
            if len(open_) and places:
                rest = [texts[i] for i in open_]
                spelled = letters.accepts(rest)
                spelled = np.concatenate([spelled, np.zeros((1, len(rest)), bool)])[places]  # -1 is the last
                kept[open_] = (grams.accepts(rest, SLACK) & spelled).any(axis=0)
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(choose, schema)


def held_out(key: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    """Whether a row is kept from training by its key; a null key counts as an empty one."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts == part


def document_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of `docs`: `key`, held_out, lang_pred, score; learned from the rows
    that are not held out."""
    model = learn(docs.where(~held_out(key)), text, lang)
    rows = docs.select(docs[key].alias("key"), held_out(key).alias("held_out"), docs[text].alias("text"))
    return predict_languages(rows, model).select(F.col("key").alias(key), "held_out", "lang_pred", "score")
