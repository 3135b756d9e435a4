"""The corpus pipeline: stages over `documents`, each calling one operator of rolecast.llm.

Each stage works on all rows that its predecessor kept. Columns other than doc_id and text
pass through, n_chars follows the text. Null texts leave at the first stage, as they have no
language; null and repeated doc_ids are rows like others; an empty table stays empty."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolecast.llm.byte_bpe import encoded_digests
from rolecast.llm.languages import explained, held_out, judge, learn
from rolecast.llm.leaks import find_leaks
from rolecast.llm.near_copies import near_copies
from rolecast.llm.repeats import remove_repeats, text_id
from rolecast.llm.texts import unused
from rolecast.session import saved

BYTE_RANKS = "byte_bpe_50k.tiktoken"


#: Columns that operators add; a table may have columns of these names already.
ADDED = ("lang_pred", "score", "class_id", "class_no", "n_links", "n_words", "n_removed", "kept_sha256", "kept_text")


def put_aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with columns of the names in ADDED renamed, and how to name them back."""
    moved: dict[str, str] = {}
    for name in docs.columns:
        if name in ADDED:
            moved[name] = unused([*docs.columns, *ADDED, *moved.values()], name)
    return docs.withColumnsRenamed(moved), {new: name for name, new in moved.items()}


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that may be of some language: filters are learned from a third of the
    labelled documents, what a language's texts usually have of them is found on another."""
    train, tried = docs.where(held_out(part=0)), docs.where(held_out(part=2))
    return explained(docs, judge(learn(train), tried), judge(learn(train, letters=1), tried))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by doc_id and then by the other columns, of each group of near copies.

    It is a minimum over whole rows, so tasks send one row of a group each."""
    given, back = put_aside(docs)
    order = ["doc_id", *[name for name in given.columns if name != "doc_id"]]
    first = near_copies(given).groupBy("class_no").agg(F.min(F.struct(*order)).alias("first"))
    return first.select("first.*").withColumnsRenamed(back).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that stand elsewhere too."""
    given, back = put_aside(docs)
    text = F.col("kept_text").alias("text")
    n_chars = F.length("kept_text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    changed = {"text": text, "n_chars": n_chars}
    cut = remove_repeats(given).select(*[changed.get(name, F.col(name)) for name in given.columns])
    return cut.withColumnsRenamed(back)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs; what is found holds for a text, so rows
    are dropped by their text."""
    id_ = unused(docs.columns, "id")
    named = docs.withColumn(id_, text_id("text"))
    leaks = find_leaks(named, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key=id_)
    return named.join(leaks.select(id_).distinct(), id_, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    return encoded_digests(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("languages", keep_languages),
    ("near_copies", keep_one_of_each),
    ("repeats", cut_repeats),
    ("leaks", drop_leaks),
    ("byte_bpe", encode),
]
#: SQL expresses none of the first four stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
