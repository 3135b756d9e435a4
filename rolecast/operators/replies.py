"""Parsing what a model sent back and choosing one reply per contact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rolecast import schema as S
from rolecast.functions import text as X

#: A line of fewer bytes never has more cells than the parser takes.
PARSED_BYTES = 20_000

_FIVE_CELLS = '(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^,"][^,]*+|),){4}[^,]*'


def keep_nonempty(replies: DataFrame, column: str = "reply") -> DataFrame:
    return replies.filter(X.has_text(F.col(column)))


def parse_reply_lines(replies: DataFrame, keep: Sequence[str] = ("chunk_id",), column: str = "reply") -> DataFrame:
    """One row per non-blank line: the four reply cells, as sent, and the shape of the line.

    Cells after the fourth are cut, missing and empty ones are null, quoted commas belong to
    their cell, and a broken line harms no other line.
    """
    # A split by one character needs no pattern. With one more at the end, every line loses one carriage return.
    cut = replies.select(*keep, F.posexplode(F.split(F.concat(F.col(column), F.lit("\r")), "\n")).alias("line_no", "line"))
    shorter = F.left(F.col("line").cast("binary"), F.octet_length("line") - 1).cast("string")
    lines = cut.withColumn("line", F.when(F.col("line").endswith("\r"), shorter).otherwise(F.col("line")))
    fields = ", ".join(f"{name} STRING" for name in S.REPLY_COLUMNS) + ", irregular STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "irregular", "escape": '"'}
    parsed = (
        lines.filter(X.has_text(F.col("line")))
        .withColumn("cells", F.from_csv(_first_cells(F.col("line")), fields, options))
        .select(*keep, "line_no", *[F.col(f"cells.{name}") for name in S.REPLY_COLUMNS], "cells.irregular")
    )
    # Counted on irregular lines only, if no fifth cell is plain to see: commas outside quotes.
    irregular = F.col("irregular")
    commas = F.length(F.regexp_replace(F.regexp_replace(_without_rest(irregular), '"[^"]*"', ""), "[^,]", ""))
    is_long = _has_fifth_cell(irregular) | (commas >= len(S.REPLY_COLUMNS))
    shape = F.when(irregular.isNull(), "ok").when(is_long, "long").otherwise("short")
    return parsed.withColumn("shape", shape).drop("irregular")


def _first_cells(line: Column) -> Column:
    """The line up to its fifth cell if it has very many: the parser refuses lines of more
    than some twenty thousand cells, and the fifth already tells that a line is long. A line
    without a fifth cell, or with a quote that is left open, stays whole, and so does one of
    fewer bytes, which is not looked at. Quantifiers are possessive, so a quoted cell is never
    read as an unquoted one."""
    # One pattern with the whole line as its other way, so that it is looked for once.
    start = F.regexp_extract(line, f"^(?:{_FIVE_CELLS}|(?s:.*))", 0)
    return F.when((F.octet_length(line) >= PARSED_BYTES) & _very_many(line), start).otherwise(line)


def _without_rest(line: Column) -> Column:
    """The line up to its fifth cell if it has very many, so that quotes far behind do not
    decide which commas are outside of them."""
    return F.when(_very_many(line), F.regexp_replace(line, f"^({_FIVE_CELLS})(?s:.*)", "$1")).otherwise(line)


def _very_many(line: Column) -> Column:
    return F.octet_length(F.substring_index(line, ",", 1_001)) < F.octet_length(line)


def _has_fifth_cell(line: Column) -> Column:
    """Whether the line goes on after four cells without quotes or with quotes all around.
    What is in quotes is taken out by a split first, as patterns take long over long cells."""
    outside = F.array_join(F.filter(F.split(line, '"'), lambda part, i: i % 2 == 0), '"')
    return outside.rlike('^(?:(?:"+|[^",]*),){4}')


def tidy_replies(parsed: DataFrame) -> DataFrame:
    """Trim persona and certainty; blank cells and missing-value words become null."""
    return parsed.withColumns(
        {name: X.tidy_reply_value(F.col(name)) for name in ("persona", "persona_certainty")}
    )


def line_shapes(parsed: DataFrame) -> DataFrame:
    """How many lines have four cells, fewer, or more."""
    return parsed.groupBy("shape").agg(F.count(F.lit(1)).alias("n"))


def parse_envelopes(lines: DataFrame, keep: Sequence[str] = (), column: str = "line") -> DataFrame:
    """Batch output lines to `prospect_id`, `content` or `error`. A bad line is an error row.

    The id of a line that tells none is empty, not null: a nullable id would make later joins
    test it for null as early as possible and parse every line a second time for that.
    """
    line = F.col(column)
    status = F.coalesce(F.col("e.response.status_code").try_cast("int"), F.lit(0))
    content = F.get(F.col("e.response.body.choices"), F.lit(0))["message"]["content"]
    message = F.nullif(F.col("e.response.body.error.message"), F.lit(""))
    # Only looked at for failed requests.
    body = F.coalesce(F.get_json_object(line, "$.response.body"), F.lit("{}"))
    is_document = F.col("e.custom_id").isNotNull() | F.coalesce(
        F.get_json_object(line, "$").startswith("{"), F.lit(False)
    )
    error = (
        F.when(~is_document, F.concat(F.lit("Invalid JSON: "), line))
        .when((status == 200) & content.isNull(), F.concat(F.lit("Malformed success body: "), body))
        .when(status != 200, F.concat(F.lit("HTTP "), status.cast("string"), F.lit(": "), F.coalesce(message, body)))
    )
    parsed = lines.filter(X.has_text(line)).withColumn("e", F.from_json(line, S.ENVELOPE))
    return parsed.select(
        *keep,
        F.coalesce(F.col("e.custom_id"), F.lit("")).alias("prospect_id"),
        F.when(status == 200, content).alias("content"),
        error.alias("error"),
    )


def parse_persona_objects(envelopes: DataFrame) -> DataFrame:
    """`content` to `persona` and `persona_certainty`; other content becomes an error."""
    content = F.col("content")
    # Read as the only element of a list: text after the object makes the list invalid.
    listed = F.from_json(F.concat(F.lit("["), content, F.lit("]")), S.PERSONA_OBJECTS, {"allowSingleQuotes": "false"})
    is_object = F.coalesce(X.strip(content).startswith("{") & (F.size("_objects") == 1), F.lit(False))
    problem = F.concat(F.lit("Invalid JSON: "), content)
    first = F.get("_objects", F.lit(0))
    return (
        envelopes.withColumn("_objects", listed)
        .withColumns(
            {
                "persona": X.tidy_reply_value(F.when(is_object, first["persona"])),
                "persona_certainty": X.tidy_reply_value(F.when(is_object, first["certainty"])),
                "error": F.coalesce(F.col("error"), F.when(content.isNotNull() & ~is_object, problem)),
            }
        )
        .drop("_objects", "content")
    )


def first_per_id(replies: DataFrame, order: Sequence[str], key: str | Sequence[str] = "prospect_id") -> DataFrame:
    """The earliest reply of each id. Partial results are merged before the shuffle."""
    return _one_per_id(replies, key, F.min_by, F.struct(*order))


def last_per_id(replies: DataFrame, order: Sequence[str], key: str = "prospect_id") -> DataFrame:
    """The latest reply of each id."""
    return _one_per_id(replies, key, F.max_by, F.struct(*order))


def last_results(envelopes: DataFrame, order: Sequence[str], key: str = "prospect_id") -> DataFrame:
    """The latest result of each id; the latest error only where there is no result."""
    return _one_per_id(envelopes, key, F.max_by, F.struct(F.col("content").isNotNull().alias("good"), *order))


def best_per_id(
    replies: DataFrame, order: Sequence[str], taxonomy: Sequence[str] = S.PERSONAS, key: str = "prospect_id"
) -> DataFrame:
    """One reply per id: the earliest valid one, else the earliest repaired one, else the earliest.

    A repaired reply carries the name it stands for in `repaired`.
    """
    rank = F.when(F.col("persona").isin(*taxonomy), 0).when(F.col("repaired").isNotNull(), 1).otherwise(2)
    return _one_per_id(replies, key, F.min_by, F.struct(rank.alias("rank"), *order))


def _one_per_id(replies: DataFrame, key: str | Sequence[str], pick, order: Column) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    others = [name for name in replies.columns if name not in keys]
    return replies.groupBy(*keys).agg(pick(F.struct(*others), order).alias("_row")).select(*keys, "_row.*")
