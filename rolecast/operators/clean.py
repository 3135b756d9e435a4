"""Row filters and column clean-up of contact tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rolecast import schema as S
from rolecast.functions import text as X


def rename_id(df: DataFrame) -> DataFrame:
    """`record_id` becomes `prospect_id` unless there is one."""
    if "record_id" in df.columns and "prospect_id" not in df.columns:
        return df.withColumnRenamed("record_id", "prospect_id")
    return df


def clean_null_tokens(df: DataFrame, columns: Sequence[str] = S.CLEANED_COLUMNS) -> DataFrame:
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: X.null_tokens_to_empty(F.col(name)) for name in present})


def drop_internal(df: DataFrame, marker: str = S.INTERNAL_MARKER, column: str = "email") -> DataFrame:
    """Drop rows whose address contains `marker`; rows without an address stay."""
    return df.filter(~F.coalesce(F.col(column), F.lit("")).contains(marker))


def drop_matching(df: DataFrame, pattern: str = S.INTERNAL_OR_TEST, column: str = "email") -> DataFrame:
    """The older address filter: drop rows whose address matches `pattern`."""
    return df.filter(~F.coalesce(F.col(column), F.lit("")).rlike(pattern))


def keep_titled(df: DataFrame, column: str = "job_title") -> DataFrame:
    return df.filter(X.has_text(F.col(column)))


def keep_title_not_null(df: DataFrame, column: str = "job_title") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def project_contacts(df: DataFrame, keep_columns: Sequence[str] = ()) -> DataFrame:
    wanted = [*S.CONTACT_COLUMNS, *keep_columns]
    return df.select(*wanted, *(["seq"] if "seq" in df.columns and "seq" not in wanted else []))


def ensure_columns(df: DataFrame, columns: Sequence[str] = S.EXPECTED_COLUMNS) -> DataFrame:
    missing = [name for name in columns if name not in df.columns]
    return df.withColumns({name: F.lit("") for name in missing}) if missing else df


def keep_valid_persona(df: DataFrame, taxonomy: Sequence[str] = S.PERSONAS, column: str = "persona") -> DataFrame:
    return df.filter(F.col(column).isin(*taxonomy))


def keep_without_persona(df: DataFrame, column: str = "persona") -> DataFrame:
    """Skipped rows that still need a persona."""
    return df.filter(~X.has_text(F.col(column)))


def keep_importable(df: DataFrame) -> DataFrame:
    return df.filter(F.col("email").isNotNull() & F.col("persona").isNotNull())


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; required: {', '.join(columns)}")
    return df


def require_rows(df: DataFrame, message: str = "no rows to work on") -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def require_none(df: DataFrame, what: str) -> None:
    if not df.isEmpty():
        raise ValueError(f"there are {what}")


def prepare_contacts(
    df: DataFrame,
    marker: str | None = S.INTERNAL_MARKER,
    pattern: str | None = None,
    keep_columns: Sequence[str] = (),
) -> DataFrame:
    """The steps every run starts with: rename, clean, filter, project."""
    df = clean_null_tokens(rename_id(df))
    if marker:
        df = drop_internal(df, marker)
    if pattern:
        df = drop_matching(df, pattern)
    return project_contacts(keep_titled(df), keep_columns)
