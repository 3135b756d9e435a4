"""What a work folder holds: the runs it was used for, their contacts and their answers.

A folder has one entry per table of contacts that it was used with: the first in the folder
itself, later ones in `night-2`, `night-3` and so on. An entry has the fingerprint of its
contacts and parameters, the contacts, who was asked, and the answers so far. Answers belong
to an id *and* the title that was asked, so a later entry takes over what still holds and
asks for the rest only."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecast.functions import text as X
from rolecast.operators.decide import contacts_without
from rolecast.operators.replies import first_per_id
from rolecast.session import finished

ANSWER_COLUMNS = ("prospect_id", "title", "persona", "persona_certainty", "night", "pass_no", "chunk_id", "line_no")


def multiset_digest(df: DataFrame) -> list[int]:
    """Row count and two independent 64-bit sums of row hashes over all columns.

    The same rows give the same digest in any order; unlike an exclusive or, a sum changes
    when a row is doubled. Nulls are told apart from empty texts and from each other's places.
    Sums are decimals, so they are exact, and are cut to 64 bits at the end."""
    names = sorted(df.columns)
    cells = [part for name in names for part in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    sums = [F.sum(F.xxhash64(F.lit(salt), *cells).cast("decimal(38,0)")).alias(salt) for salt in ("first", "second")]
    row = df.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    return [row["n"], *[int(row[salt] or 0) % 2**64 for salt in ("first", "second")]]


def fingerprint(contacts: DataFrame, **parameters) -> str:
    """What tells one run from another: its contacts with all their columns, and its parameters."""
    return json.dumps({"columns": sorted(contacts.columns), "contacts": multiset_digest(contacts), **parameters}, sort_keys=True, default=list)


def parameters_of(mark: str) -> dict:
    return {name: value for name, value in json.loads(mark).items() if name not in ("columns", "contacts")}


def night_dir(work_dir: str, night: int) -> str:
    return work_dir if night == 1 else f"{work_dir}/night-{night}"


def marks(spark: SparkSession, work_dir: str) -> list[str]:
    """Fingerprints of the entries of a folder, in order."""
    found: list[str] = []
    while finished(spark, path := f"{night_dir(work_dir, len(found) + 1)}/fingerprint"):
        found.append(spark.read.text(path).first()["value"])
    return found


def claim(spark: SparkSession, work_dir: str, mark: str, grow: bool = False) -> int:
    """The entry of a folder that belongs to this fingerprint: the last one if it is the same,
    else, with `grow`, a new one. Other contacts without `grow`, and other parameters at any
    time, are an error."""
    found = marks(spark, work_dir)
    if found and found[-1] == mark:
        return len(found)
    if found and not (grow and parameters_of(found[-1]) == parameters_of(mark)):
        raise ValueError(f"{work_dir} belongs to a run with other contacts or parameters")
    night = len(found) + 1
    spark.createDataFrame([(mark,)], "value string").write.mode("overwrite").text(f"{night_dir(work_dir, night)}/fingerprint")
    return night


def titles(contacts: DataFrame) -> DataFrame:
    """`prospect_id`, `title`, `job_title`, `seq`: one row per id, the first, as decisions have
    it. Contacts without an id are left out: no reply could be matched to them."""
    known = contacts.filter(X.has_text(F.col("prospect_id"))).select("prospect_id", "job_title", "seq")
    return first_per_id(known, ["seq"]).withColumn("title", F.coalesce("job_title", F.lit("")))


def stage_asked(contacts: DataFrame, known: DataFrame | None, path: str) -> DataFrame:
    """Write whom to ask: all of `titles`, without those whose title has an accepted answer
    in `known`."""
    spark = contacts.sparkSession
    if not finished(spark, path):
        todo = titles(contacts)
        if known is not None:
            todo = todo.join(known.select("prospect_id", "title").distinct(), ["prospect_id", "title"], "left_anti")
        todo.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_answers(asked: DataFrame, parsed: DataFrame, before: DataFrame | None, night: int, path: str) -> DataFrame:
    """Write the answers to what was asked, after those of earlier nights. A reply with an id
    that was not asked for is no answer."""
    spark = asked.sparkSession
    if not finished(spark, path):
        own = parsed.join(asked.select("prospect_id", "title"), "prospect_id").withColumn("night", F.lit(night))
        own = own.select(*ANSWER_COLUMNS)
        (own if before is None else before.unionByName(own)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def answers_for(contacts: DataFrame, answers: DataFrame) -> DataFrame:
    """The answers that are about the titles these contacts have now."""
    return answers.join(titles(contacts).select("prospect_id", "title"), ["prospect_id", "title"], "left_semi").drop("title")


def unanswered(asked: DataFrame, accepted: DataFrame) -> DataFrame:
    return contacts_without(asked, accepted)
