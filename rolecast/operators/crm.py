"""Preparing the write-back of personas to a CRM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from rolecast import schema as S
from rolecast.functions import text as X
from rolecast.operators.clean import keep_importable, require_columns
from rolecast.operators.lookups import lookup_join
from rolecast.operators.numbering import assign_chunks
from rolecast.session import saved


def with_enum(df: DataFrame, mapping: Mapping[str, str] = S.CRM_ENUM, name: str = "persona_enum") -> DataFrame:
    """Add the CRM value of a persona: exact name, else regardless of case, else the name itself.

    The two dimensions are built from `mapping` on the driver, so their size is known.
    """
    if not mapping:
        raise ValueError("the persona mapping is empty")
    folded: dict[str, str] = {}
    for key, value in mapping.items():
        folded.setdefault(key.lower(), value)
    spark = df.sparkSession
    exact = spark.createDataFrame(list(mapping.items()), "_exact string, _exact_enum string")
    loose = spark.createDataFrame(list(folded.items()), "_loose string, _loose_enum string")
    named = df.withColumn("_name", X.strip(F.col("persona")))
    return (
        named.join(F.broadcast(exact), F.col("_name") == F.col("_exact"), "left")
        .join(F.broadcast(loose), F.lower("_name") == F.col("_loose"), "left")
        .withColumn(name, F.coalesce("_exact_enum", "_loose_enum", "_name"))
        .drop("_name", "_exact", "_exact_enum", "_loose", "_loose_enum")
    )


def email_key(column: str = "email"):
    return F.lower(X.strip(F.col(column)))


def lookup_emails(rows: DataFrame) -> DataFrame:
    """The distinct addresses to look up."""
    return rows.select(X.strip(F.col("email")).alias("email")).distinct()


def ids_by_email(emails: DataFrame, crm_contacts: DataFrame) -> DataFrame:
    """`email_key`, `found_id`: the first CRM contact with each address, whatever its case.

    `crm_contacts` is flat, with `prospect_id` and `email`; "first" is the smallest id.
    """
    wanted = emails.select(email_key().alias("email_key")).distinct()
    known = (
        crm_contacts.filter(X.has_text(F.col("prospect_id")) & X.has_text(F.col("email")))
        .select(email_key().alias("email_key"), F.col("prospect_id"))
        .groupBy("email_key")
        .agg(F.min_by("prospect_id", F.struct(F.length("prospect_id"), "prospect_id")).alias("found_id"))
    )
    return wanted.join(known, "email_key", "inner")


def resolve_ids(rows: DataFrame, crm_contacts: DataFrame, spread_by: tuple[str, ...], **limits: int) -> DataFrame:
    """Add `contact_id` and `id_source`: the row's own id, one found by address, or none.

    `rows` is read twice: for the addresses to look up and for the join.
    """
    rows = keep_importable(require_columns(rows, ("email", "persona")))
    own = X.blank_to_null(F.col("prospect_id")) if "prospect_id" in rows.columns else F.lit(None).cast("string")
    keyed = rows.withColumn("_own", X.strip(own))
    asked = keyed.filter(F.col("_own").isNull())
    found = saved(ids_by_email(lookup_emails(asked), crm_contacts), "ids-by-email")
    # Rows with an id of their own have a null key: they match nothing and are not bunched.
    keyed = keyed.withColumn("email_key", F.when(F.col("_own").isNull(), email_key()))
    joined = lookup_join(keyed, found, "email_key", spread_by, **limits)
    source = F.when(F.col("_own").isNotNull(), "own").when(F.col("found_id").isNotNull(), "email").otherwise("not_found")
    return joined.withColumns({"contact_id": F.coalesce("_own", "found_id"), "id_source": source}).drop(
        "_own", "email_key", "found_id"
    )


def update_records(
    resolved: DataFrame,
    mapping: Mapping[str, str] = S.CRM_ENUM,
    persona_property: str = S.CRM_PERSONA_PROPERTY,
    certainty_property: str = S.CRM_CERTAINTY_PROPERTY,
) -> DataFrame:
    """Add `record`, the JSON update of each row that has a contact id; others are left out."""
    known = with_enum(resolved.filter(F.col("contact_id").isNotNull()), mapping)
    certainty = F.col("persona_certainty") if "persona_certainty" in resolved.columns else F.lit(None).cast("string")
    properties = F.struct(F.col("persona_enum").alias(persona_property), certainty.alias(certainty_property))
    record = F.struct(F.col("contact_id").alias("id"), properties.alias("properties"))
    return known.withColumn("record", F.to_json(record))


def with_blocks(records: DataFrame, size: int = S.CRM_BLOCK, order_by: str = "seq") -> DataFrame:
    """Consecutive blocks of `size` records, numbered from 1."""
    return assign_chunks(records, size, order_by, "block_no").withColumn("block_no", F.col("block_no") + 1)


def update_blocks(records: DataFrame, size: int = S.CRM_BLOCK, order_by: str = "seq") -> DataFrame:
    """`block_no`, `n`, `payload`: one update call per block of `size` records."""
    entries = with_blocks(records, size, order_by).select("block_no", F.struct("row_no", "record").alias("entry"))
    inputs = F.array_join(F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["record"]), ",")
    return entries.groupBy("block_no").agg(
        F.count(F.lit(1)).alias("n"), F.concat(F.lit('{"inputs":['), inputs, F.lit("]}")).alias("payload")
    )


def import_totals(resolved: DataFrame, outcomes: DataFrame, size: int = S.CRM_BLOCK, order_by: str = "seq") -> DataFrame:
    """Rows per result: `success` or `failed` by the outcome of their block, or `not_found`.

    `outcomes` has `block_no` and `status`. Blocks are counted before the join.
    """
    found = resolved.filter(F.col("contact_id").isNotNull())
    sizes = with_blocks(found, size, order_by).groupBy("block_no").agg(F.count(F.lit(1)).alias("n"))
    sent = sizes.join(outcomes.select("block_no", "status"), "block_no", "left").select(
        F.when(F.col("status") == "success", "success").otherwise("failed").alias("result"), "n"
    )
    missing = resolved.filter(F.col("contact_id").isNull()).select(
        F.lit("not_found").alias("result"), F.lit(1).cast("long").alias("n")
    )
    return sent.unionByName(missing).groupBy("result").agg(F.sum("n").alias("n"))
