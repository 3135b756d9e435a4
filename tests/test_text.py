import pytest
from pyspark.sql import functions as F

from helpers import rows
from rolecast import schema as S
from rolecast.functions import text as X


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_duration(spark):
    seconds = [None, -1.0, float("inf"), float("nan"), 0.0, 59.9, 60.0, 3599.0, 3600.0, 7384.0]
    shown = column(spark, seconds, "double", X.duration_text)
    assert shown == ["—", "—", "—", "—", "0s", "59s", "1m 0s", "59m 59s", "1h 0m 0s", "2h 3m 4s"]


def test_retry_hint(spark):
    messages = ["try again in 12s", "429: try again in 12.5s | x", "later", "", None, "try again in .5s"]
    assert column(spark, messages, "string", X.retry_hint_seconds) == [12.0, 12.5, 0.0, 0.0, 0.0, 0.0]


def test_backoff_and_chunk(spark):
    df = spark.createDataFrame(
        [(0, "x", 250), (4, "x", 250), (1, "429 try again in 40s", 250), (0, "Rate Limit", 15), (0, "429", 7)],
        "attempt int, error string, size int",
    )
    got = df.select(
        X.backoff_seconds(F.col("attempt"), F.col("error")), X.chunk_after_error(F.col("error"), F.col("size"))
    ).collect()
    assert [tuple(r) for r in got] == [(2.0, 250), (30.0, 250), (40.0, 125), (2.0, 10), (2.0, 7)]


def test_pause_shares_the_budget(spark):
    assert column(spark, [10, 250], "long", X.pause_seconds) == [1.5, 5.0]
    assert column(spark, [250], "long", lambda n: X.pause_seconds(n, 4)) == [20.0]


def test_titles(spark):
    assert column(spark, ["VP, Sales", None, ",a,,b"], "string", X.sanitize_title) == ["VP  Sales", "", " a  b"]
    blanks = ["", " ", "\t\n", " 　", None, "x", " x "]
    assert column(spark, blanks, "string", X.has_text) == [False] * 5 + [True] * 2


@pytest.mark.parametrize("blank", [c for c in S.BLANKS])
def test_every_blank_is_a_blank(blank):
    assert blank.isspace()


def test_null_tokens(spark):
    cells = ["nan", "NaN", "None", "none", " nan", None, "x"]
    assert column(spark, cells, "string", X.null_tokens_to_empty) == ["", "", "", "none", " nan", "", "x"]


def test_reasons(spark):
    personas = ["Data User", " Data User ", "data user", "", "  ", None]
    assert column(spark, personas, "string", X.skip_reason) == [
        None,
        None,
        "Invalid persona: data user",
        "No LLM response",
        "No LLM response",
        "No LLM response",
    ]
    df = spark.createDataFrame(
        [(None, "HTTP 500: {}"), (None, None), ("Wizard", "x"), ("Data User", None)], "p string, e string"
    )
    got = [r[0] for r in df.select(X.batch_skip_reason(F.col("p"), F.col("e"))).collect()]
    assert got == ["Batch error: HTTP 500: {}", "Batch error: No LLM response", "Invalid persona: Wizard", None]


def test_prefer_new_twice_is_once(spark):
    df = spark.createDataFrame([("a", "b"), (" ", "b"), (None, "b"), (" a ", None)], "n string, o string")
    once = df.withColumn("o", X.prefer_new(F.col("n"), F.col("o")))
    twice = once.withColumn("o", X.prefer_new(F.col("n"), F.col("o")))
    assert rows(once) == rows(twice)
    assert [r["o"] for r in once.collect()] == ["a", "b", "b", " a "]


def test_other_taxonomies(spark):
    for names in (S.PERSONAS_FIVE, S.PERSONAS_SIX):
        got = column(spark, list(names), "string", lambda p: X.skip_reason(p, names))
        assert got == [None] * len(names)
