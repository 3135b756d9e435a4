"""Joining replies to contacts and deciding who is accepted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rolecast import schema as S
from rolecast.functions import text as X
from rolecast.operators.lookups import lookup_join
from rolecast.operators.repair import with_repairs
from rolecast.operators.replies import best_per_id, first_per_id

REPLY_VALUES = ("persona", "persona_certainty")


def join_replies(contacts: DataFrame, replies: DataFrame) -> DataFrame:
    """All contacts, with the values of their reply where there is one.

    Both sides have one row per id. The contact's own title is the one kept.
    """
    return contacts.join(_reply_values(contacts, replies), "prospect_id", "left")


def answered_contacts(contacts: DataFrame, replies: DataFrame, **limits: int) -> DataFrame:
    """The older form: one row per reply of a known contact; unanswered contacts are left out."""
    values = _reply_values(contacts, replies)
    spread = [name for name in values.columns if name != "prospect_id"]
    return lookup_join(values, contacts, "prospect_id", spread, "inner", **limits)


def _reply_values(contacts: DataFrame, replies: DataFrame) -> DataFrame:
    return replies.select(*[c for c in replies.columns if c == "prospect_id" or c not in contacts.columns])


def contacts_without(contacts: DataFrame, done: DataFrame, key: str = "prospect_id") -> DataFrame:
    """Contacts whose id is not in `done`: the audit of a run, and what a resumed run has left."""
    return contacts.join(done.select(key).distinct(), key, "left_anti")


def contacts_within(contacts: DataFrame, ids: DataFrame, key: str = "prospect_id") -> DataFrame:
    return contacts.join(ids.select(key).distinct(), key, "left_semi")


def with_skip_reason(joined: DataFrame, taxonomy: Sequence[str] = S.PERSONAS) -> DataFrame:
    return joined.withColumn("skip_reason", X.skip_reason(F.col("persona"), taxonomy))


def with_batch_reason(joined: DataFrame, taxonomy: Sequence[str] = S.PERSONAS) -> DataFrame:
    reason = X.batch_skip_reason(F.col("persona"), F.col("error"), taxonomy)
    return joined.withColumn("skip_reason", reason).drop("error")


def decide(
    contacts: DataFrame,
    replies: DataFrame,
    order: Sequence[str],
    taxonomy: Sequence[str] = S.PERSONAS,
    threshold: int | None = S.FUZZY_THRESHOLD,
    batch: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One decision per contact id. `keep` names columns of the replies to hand on.

    `replies` has `prospect_id`, `persona`, `persona_certainty`, the `order` columns and, in
    batch mode, `error`. A valid reply wins over a repaired one, and that over any other;
    among equals the earliest. Without `threshold` nothing is repaired. Contacts and replies
    are both cut to one row per id before they meet, so the join has no hot key. A contact
    without an id is a row of its own that no reply belongs to; `seq` tells contacts apart.
    """
    if "seq" not in contacts.columns:
        raise ValueError("contacts need seq, the order that decides which row of an id stays")
    columns = [name for name in replies.columns if name not in ("repaired", "job_title")]
    replies = replies.select(*columns)
    if threshold is None:
        replies = replies.withColumn("repaired", F.lit(None).cast("string"))
    else:
        replies = with_repairs(replies, ["prospect_id", *order], taxonomy, threshold)
    chosen = best_per_id(replies, order, taxonomy).withColumn(
        "persona", F.coalesce(F.when(F.col("persona").isin(*taxonomy), F.col("persona")), "repaired", "persona")
    )
    values = [*REPLY_VALUES, *keep, *(["error"] if batch else [])]
    # Not a filter: on the key of the join it would reach the replies and parse them twice.
    has_id = X.has_text(F.col("prospect_id"))
    # One key for grouping and joining, so that contacts are shuffled once; those without an
    # id have keys of their own and are spread over all tasks.
    alone = F.concat(F.lit("\0"), F.col("seq").cast("string"))
    keyed = contacts.withColumn("_key", F.when(has_id, F.col("prospect_id")).otherwise(alone))
    unique = first_per_id(keyed, ["seq"], "_key")
    answers = chosen.select(F.col("prospect_id").alias("_key"), *[name for name in values if name not in contacts.columns])
    joined = unique.join(answers, "_key", "left").drop("_key")
    joined = joined.withColumns({name: F.when(has_id, F.col(name)) for name in values})
    return with_batch_reason(joined, taxonomy) if batch else with_skip_reason(joined, taxonomy)


def accepted(decisions: DataFrame) -> DataFrame:
    return decisions.filter(F.col("skip_reason").isNull())


def skipped(decisions: DataFrame) -> DataFrame:
    return decisions.filter(F.col("skip_reason").isNotNull())


def merge_corrected(accepted_rows: DataFrame, contacts: DataFrame, corrected: DataFrame) -> DataFrame:
    """Append corrected contacts to the accepted ones; an id already accepted stays as it is."""
    values = first_per_id(corrected.select("prospect_id", *REPLY_VALUES, "seq"), ["seq"]).drop("seq")
    back = contacts.join(values, "prospect_id", "inner")
    columns = ["prospect_id", "email", "job_title", *REPLY_VALUES, "seq"]
    both = accepted_rows.select(*columns, F.lit(0).alias("_late")).unionByName(
        back.select(*columns, F.lit(1).alias("_late"))
    )
    return first_per_id(both, ["_late", "seq"]).drop("_late")


def join_rerun(skipped_rows: DataFrame, results: DataFrame, **limits: int) -> DataFrame:
    """Skipped rows with the values of a rerun; their former values end in `_old`.

    `results` has one row per id. Every skipped row is kept, also when an id occurs many times.
    """
    former = skipped_rows.withColumnsRenamed({name: f"{name}_old" for name in REPLY_VALUES})
    spread = [name for name in former.columns if name != "prospect_id"]
    return lookup_join(former, results, "prospect_id", spread, **limits)


def update_skipped(
    skipped_rows: DataFrame, results: DataFrame, taxonomy: Sequence[str] = S.PERSONAS, **limits: int
) -> DataFrame:
    """Skipped rows after a rerun: new values where there are any, and a fresh reason.

    `results` has `prospect_id`, `persona`, `persona_certainty` and `error`; one without an id
    belongs to no row.
    """
    known = results.filter(X.has_text(F.col("prospect_id"))).select("prospect_id", *REPLY_VALUES, "error")
    joined = join_rerun(skipped_rows.drop("skip_reason"), known, **limits)
    updated = joined.withColumns({name: X.prefer_new(F.col(name), F.col(f"{name}_old")) for name in REPLY_VALUES})
    return with_batch_reason(updated.drop(*[f"{name}_old" for name in REPLY_VALUES]), taxonomy)
