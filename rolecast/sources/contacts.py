"""Reading contact tables from files and from CRM tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecast import schema as S
from rolecast.operators.clean import clean_null_tokens, ensure_columns, rename_id, require_rows
from rolecast.sources.archive import read_archives
from rolecast.sources.crm import list_contacts, report_contacts
from rolecast.sources.csv_blocks import read_csv_by_name


@dataclass(frozen=True)
class CrmTables:
    """CRM data on hand: nested contacts, list memberships, and the lists of each report."""

    contacts: DataFrame
    memberships: DataFrame
    report_lists: DataFrame | None = None


def inside_names(df: DataFrame) -> DataFrame:
    """Display names of known columns to the names used inside; others stay."""
    return df.withColumnsRenamed({name: S.DISPLAY_NAMES[name] for name in df.columns if name in S.DISPLAY_NAMES})


def read_csv_contacts(spark: SparkSession, path: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """CSV with a header, every column text, empty cells as empty text, columns by name."""
    named = inside_names(read_csv_by_name(spark, path, multi_line))
    return clean_null_tokens(rename_id(named.fillna("")))


def read_skipped(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """A skipped file of an earlier run; blank cells are null. Titles may hold line breaks."""
    raw = inside_names(read_csv_by_name(spark, path, multi_line))
    return raw if "persona" in raw.columns else raw.withColumn("persona", F.lit(None).cast("string"))


def union_sheets(sheets: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of all data sheets of a sheet-tagged table; the summary sheet is left out."""
    return sheets.filter(F.col("sheet") != S.SUMMARY_SHEET).select(*columns)


def concat_sheets(sheets: dict[str, DataFrame]) -> DataFrame:
    """Sheets of one workbook stacked by column name, without the summary sheet."""
    data = [frame for name, frame in sheets.items() if name != S.SUMMARY_SHEET]
    if not data:
        raise ValueError("no data sheet in the workbook")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), data)


def files_named(spark: SparkSession, folder: str, patterns: Sequence[str]) -> bool:
    """Whether a folder holds files of such names; only the listing is read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "{" + ",".join(patterns) + "}")
    return not listing.load(folder).select("path").isEmpty()


def read_contacts(
    spark: SparkSession,
    uri: str,
    crm: CrmTables | None = None,
    limit: int | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Contacts from a file, a folder of Parquet or CSV files, or `list:<id>`, `segment:<id>`,
    `hubspot:<id>`, `<id>`. Only a `limit` that is asked for caps a list or report."""
    uri = uri.strip().strip('"').strip("'")
    is_list = uri.startswith(("list:", "segment:"))
    if is_list or uri.startswith("hubspot:") or uri.isdigit():
        identifier = re.sub(r"hubspot:|list:|segment:", "", uri).strip()
        if not identifier:
            raise ValueError("a list, segment or report id is required")
        if crm is None:
            raise ValueError("CRM tables are needed to read a list or report")
        if is_list:
            pulled = list_contacts(crm.contacts, crm.memberships, identifier, limit)
        else:
            pulled = report_contacts(crm.contacts, crm.memberships, crm.report_lists, identifier, limit)
        return ensure_columns(require_rows(pulled, f"no contacts found for {uri}"))
    kind = uri.lower()
    if kind.endswith((".csv", ".csv.gz")):
        return read_csv_contacts(spark, uri, multi_line)
    if kind.endswith(".zip"):
        return read_archives(spark, uri)
    if kind.endswith("/") and files_named(spark, uri, ("*.csv", "*.csv.gz")):
        return read_csv_contacts(spark, uri, multi_line)
    if kind.endswith((".parquet", "/")):
        return clean_null_tokens(rename_id(inside_names(spark.read.parquet(uri))))
    if kind.endswith((".xls", ".xlsx")):
        raise ValueError("read the sheets with a reader of your choice and pass them to concat_sheets")
    raise ValueError(f"unsupported source: {uri}")
