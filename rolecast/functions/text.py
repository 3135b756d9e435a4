"""Column expressions on contact and reply text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from rolecast import schema as S


def strip(text: Column) -> Column:
    """Cut blank characters of any script from both ends."""
    return F.btrim(text, F.lit(S.BLANKS))


def has_text(text: Column) -> Column:
    """Whether there is any character that is not blank. Never null."""
    return F.coalesce(text, F.lit("")).rlike(f"[^{S.BLANKS}]")


def blank_to_null(text: Column) -> Column:
    """The text unchanged, or null when it is blank."""
    return F.when(has_text(text), text)


def null_tokens_to_empty(text: Column, tokens: Sequence[str] = S.NULL_TOKENS) -> Column:
    return F.when(text.isin(*tokens), "").otherwise(F.coalesce(text, F.lit("")))


def tidy_reply_value(text: Column) -> Column:
    """Trimmed reply cell; blank cells and missing-value words become null."""
    trimmed = strip(text)
    return F.when((trimmed != "") & ~trimmed.isin(*S.REPLY_NULL_TOKENS), trimmed)


def sanitize_title(title: Column) -> Column:
    return F.translate(F.coalesce(title, F.lit("")), ",", " ")


def retry_hint_seconds(message: Column) -> Column:
    """Seconds a rate-limited server asked to wait, 0.0 without such a hint."""
    hint = F.nullif(F.regexp_extract(message, S.RETRY_HINT, 1), F.lit(""))
    return F.coalesce(hint.cast("double"), F.lit(0.0))


def is_rate_limit(message: Column) -> Column:
    return F.lower(message).contains("rate limit") | message.contains("429")


def backoff_seconds(
    attempt: Column,
    message: Column,
    first: float = S.FIRST_BACKOFF_SECONDS,
    cap: float = S.MAX_BACKOFF_SECONDS,
) -> Column:
    """Wait before the next try; `attempt` counts from 0. Random jitter is left to the caller."""
    exponential = F.least(F.lit(cap), F.lit(first) * F.pow(F.lit(2.0), attempt.cast("double")))
    return F.greatest(retry_hint_seconds(message), exponential)


def chunk_after_error(message: Column, size: Column, smallest: int = S.MIN_CHUNK) -> Column:
    """Chunk size to use after a failed call: halved on a rate limit, never grown."""
    halved = F.greatest(F.lit(smallest), F.floor(size / 2).cast("int"))
    return F.when(is_rate_limit(message), F.least(size, halved)).otherwise(size)


def pause_seconds(rows: Column, calls_in_parallel: int = 1) -> Column:
    """Pause after a call of `rows` rows that keeps all callers inside the token budget."""
    spent = estimated_tokens(rows).cast("double") / F.lit(float(S.TOKENS_PER_MINUTE)) * F.lit(60.0)
    return F.greatest(F.lit(S.BASE_PAUSE_SECONDS), spent) * F.lit(float(calls_in_parallel))


def estimated_tokens(rows: Column) -> Column:
    return rows * F.lit(S.TOKENS_PER_ROW)


def duration_text(seconds: Column) -> Column:
    """`2h 3m 4s`, `3m 4s` or `4s`; a dash when the duration is unknown."""
    value = seconds.cast("double")
    known = value.isNotNull() & ~F.isnan(value) & (value >= 0) & (value < float("inf"))
    whole = F.when(known, value).cast("long")
    hours = F.floor(whole / 3600).cast("string")
    minutes = (F.floor(whole / 60) % 60).cast("string")
    rest = (whole % 60).cast("string")
    return (
        F.when(~known, S.UNKNOWN_DURATION)
        .when(whole >= 3600, F.concat(hours, F.lit("h "), minutes, F.lit("m "), rest, F.lit("s")))
        .when(whole >= 60, F.concat(minutes, F.lit("m "), rest, F.lit("s")))
        .otherwise(F.concat(rest, F.lit("s")))
    )


def skip_reason(persona: Column, taxonomy: Sequence[str] = S.PERSONAS) -> Column:
    """Why a contact cannot be accepted, null when it can."""
    name = strip(persona)
    return (
        F.when(~has_text(persona), S.NO_RESPONSE)
        .when(~name.isin(*taxonomy), F.concat(F.lit(S.INVALID_PREFIX), name))
    )


def batch_skip_reason(persona: Column, error: Column, taxonomy: Sequence[str] = S.PERSONAS) -> Column:
    """As `skip_reason`, with the error of the request when there is no persona."""
    cause = F.concat(F.lit(S.BATCH_PREFIX), F.coalesce(error, F.lit(S.NO_RESPONSE)))
    return F.when(~has_text(persona), cause).otherwise(skip_reason(persona, taxonomy))


def prefer_new(new: Column, old: Column) -> Column:
    return F.coalesce(blank_to_null(new), old)
