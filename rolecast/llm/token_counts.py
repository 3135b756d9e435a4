"""Token counts of texts (operator 8): lengths only, from Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rolecast.llm.texts import raw, slices

#: Distinct words a worker remembers; a full memory is emptied, so this bounds it.
REMEMBERED_WORDS = 1_200_000
#: Bytes given to the library at once.
CALL_BYTES = 200_000


@cache
def drops_spaces(path: str) -> bool:
    """Whether a tokenizers file removes white space before its merges, so that no token
    crosses it and a text may be cut there."""
    with open(path, encoding="utf-8") as file:
        step = json.load(file).get("pre_tokenizer") or {}
    first = (step.get("pretokenizers") or [step])[0]
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))


@cache
def lowers(path: str) -> bool:
    """Whether a tokenizers file makes its texts lower case."""
    with open(path, encoding="utf-8") as file:
        step = json.load(file).get("normalizer") or {}
    return any(part.get("type") == "Lowercase" for part in step.get("normalizers") or [step])


def split_words(text: bytes, lower: bool) -> list[bytes]:
    """Words of a text, without capitals if the tokenizer ignores them; special tokens
    (all hold `<|`) are spelled as they are."""
    return (text.lower() if lower and b"<|" not in text else text).split()


def by_bytes(items: list[bytes], limit: int = CALL_BYTES) -> Iterator[list[bytes]]:
    """Items in order, in lists of about `limit` bytes."""
    part, size = [], 0
    for item in items:
        part.append(item)
        size += len(item)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


#: Words of letters that are encoded as one text.
TOGETHER = 200


def ends_words(path: str, vocabulary: dict[str, int]) -> np.ndarray | None:
    """For each id, whether it ends a word; None if tokens do not tell."""
    with open(path, encoding="utf-8") as file:
        suffix = json.load(file)["model"].get("end_of_word_suffix")
    if not suffix or not drops_spaces(path):
        return None
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
    return ends


def encode_words(path: str, convert: Callable) -> Callable[[list[bytes]], list]:
    """A function that encodes words with a tokenizers file and gives `convert(ids)` of each.

    Words of ASCII letters are one piece each to a tokenizer that drops white space; if its
    tokens tell the ends of words, such words are encoded as texts of many words, which costs
    less, and taken apart at these tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ends = ends_words(path, tokenizer.get_vocab())

    def ids_of(texts: list[bytes]) -> Iterator[list[int]]:
        for part in by_bytes(texts):
            for item in tokenizer.encode_batch_fast([text.decode() for text in part], add_special_tokens=False):
                yield item.ids

    def encode(words: list[bytes]) -> list:
        if ends is None:
            return [convert(ids) for ids in ids_of(words)]
        done: dict[bytes, object] = {}
        letters = [word for word in words if word.isalpha()]
        groups = [letters[i : i + TOGETHER] for i in range(0, len(letters), TOGETHER)]
        for group, ids in zip(groups, ids_of([b" ".join(group) for group in groups])):
            cuts = (np.flatnonzero(ends[ids]) + 1).tolist()
            if len(cuts) == len(group):  # else they are encoded one by one
                done.update((word, convert(ids[i:j])) for word, i, j in zip(group, [0, *cuts], cuts))
        others = [word for word in words if word not in done]
        done.update(zip(others, map(convert, ids_of(others))))
        return [done[word] for word in words]

    return encode


class Remembered:
    """word -> value for the words of a slice; each distinct word is computed once while it
    is remembered."""

    def __init__(self, compute: Callable[[list[bytes]], list], limit: int = REMEMBERED_WORDS):
        self.compute, self.limit, self.known = compute, limit, {}

    def of(self, words: list[bytes]) -> dict:
        wanted = set(words)
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = wanted
        new = list(new)
        self.known.update(zip(new, self.compute(new)))
        return self.known


_COUNTERS: dict[str, Callable[[list[bytes]], list[int]]] = {}


def counter(path: str) -> Callable[[list[bytes]], list[int]]:
    """A function that counts the tokens of texts; one per worker and file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = _new_counter(path)
    return _COUNTERS[path]


def _new_counter(path: str) -> Callable[[list[bytes]], list[int]]:
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def pieces(texts: list[bytes]) -> list[int]:
            found = []
            for part in by_bytes(texts):
                found.extend(map(len, model.encode([text.decode() for text in part], num_threads=1)))
            return found

        return pieces
    encode = encode_words(path, len)
    if not drops_spaces(path):
        return encode
    memory, lower = Remembered(encode), lowers(path)

    def words(texts: list[bytes]) -> list[int]:
        split = [split_words(text, lower) for text in texts]
        known = memory.of([word for text in split for word in text])
        return [sum(map(known.__getitem__, text)) for text in split]

    return words


def token_counts(docs: DataFrame, path: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key`, n_bytes, n_tokens, over_limit (n_tokens > limit).

    The tokenizer file is a .json of tokenizers or a .model of sentencepiece that every
    executor has at `path`. Texts reach the library in calls balanced by bytes. If the file
    drops white space, texts are cut there and equal words are encoded once per worker;
    else they are encoded whole, as no other cut is safe for every file. A null or empty
    text has no tokens; a null key stays null; repeated rows each get a row; other columns
    are not read."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = raw(batch.column("text"))
            counts = counter(path)(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=[key, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
