"""Contacts from CRM tables: nested records, lists and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolecast import schema as S
from rolecast.operators.lookups import lookup_join


def read_crm_contacts(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per line."""
    return spark.read.schema(S.CRM_CONTACT).json(path)


def _property(name: str) -> Column:
    return F.coalesce(F.col(f"properties.{name}"), F.lit(""))


def flatten_list_contacts(contacts: DataFrame) -> DataFrame:
    """Nested contacts to columns; the id is `hs_object_id`, else the record's own."""
    own = F.nullif(F.col("properties.hs_object_id"), F.lit(""))
    return contacts.select(
        F.coalesce(own, F.col("id"), F.lit("")).alias("prospect_id"),
        _property("email").alias("email"),
        _property("jobtitle").alias("job_title"),
        _property("company").alias("company"),
    )


def flatten_report_contacts(contacts: DataFrame) -> DataFrame:
    """As `flatten_list_contacts` with names, and `hs_object_id` as the only id."""
    return contacts.select(
        _property("hs_object_id").alias("prospect_id"),
        _property("email").alias("email"),
        _property("jobtitle").alias("job_title"),
        _property("firstname").alias("first_name"),
        _property("lastname").alias("last_name"),
        _property("company").alias("company"),
    )


def member_ids(memberships: DataFrame) -> DataFrame:
    """`list_id`, `member_id` of memberships: the contact id, else the record id; blanks left out."""
    member = F.coalesce(F.nullif(F.col("contact_id"), F.lit("")), F.nullif(F.col("record_id"), F.lit("")))
    return memberships.select("list_id", member.alias("member_id")).filter(F.col("member_id").isNotNull())


def first_rows(df: DataFrame, limit: int | None, id_column: str) -> DataFrame:
    """At most `limit` rows, those with the smallest ids; all rows without a limit."""
    if limit is None:
        return df
    return df.orderBy(F.length(id_column), id_column).limit(limit)


def list_contacts(
    contacts: DataFrame, memberships: DataFrame, list_id: str, limit: int | None = None
) -> DataFrame:
    """The contacts of one list. Members without a contact record drop out."""
    ids = member_ids(memberships).filter(F.col("list_id") == str(list_id)).select("member_id").distinct()
    chosen = first_rows(ids, limit, "member_id")
    key = F.coalesce(F.nullif(F.col("properties.hs_object_id"), F.lit("")), F.col("id"))
    return flatten_list_contacts(contacts.join(chosen, key == F.col("member_id"), "left_semi"))


def report_contacts(
    contacts: DataFrame,
    memberships: DataFrame,
    report_lists: DataFrame | None,
    report_id: str,
    limit: int | None = None,
) -> DataFrame:
    """Contacts in any list of a report, each once; all contacts if the report has no list."""
    lists = None
    if report_lists is not None:
        lists = report_lists.filter(F.col("report_id") == str(report_id)).select("list_id").distinct()
    if lists is not None and not lists.isEmpty():
        # The lists are measured and broadcast, so that a large list is not one task's work.
        members = lookup_join(member_ids(memberships), lists, "list_id", ("member_id",), "left_semi")
        ids = members.select("member_id").distinct()
        contacts = contacts.join(ids, F.col("id") == F.col("member_id"), "left_semi")
    return flatten_report_contacts(first_rows(contacts, limit, "id"))
