from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import plan_of, rows
from rolecast import schema as S
from rolecast.operators import decide as D
from rolecast.operators import report
from rolecast.operators.classify import remaining_ids
from rolecast.operators.replies import tidy_replies


def contacts(spark, ids):
    return spark.createDataFrame(
        [(i, f"{i}@x.example", "Title", n) for n, i in enumerate(ids)],
        "prospect_id string, email string, job_title string, seq long",
    )


def replies(spark, values):
    return spark.createDataFrame(values, "prospect_id string, n int, persona string, persona_certainty string")


def test_each_kind(spark):
    given_replies = replies(
        spark,
        [("1", 1, "Data User", "9"), ("2", 1, " Data User ", "8"), ("3", 1, "Wizard", "7"), ("3", 2, "Data User", "6"),
         ("4", 1, "Economic buyer", "5"), ("5", 1, "", ""), ("6", 1, "Wizard", "4"), ("9", 1, "Data User", "1"),
         ("8", 1, "Developer", "3"), ("8", 2, "Not a target", "2")],
    )
    decided = D.decide(contacts(spark, "1234567" + "8"), tidy_replies(given_replies), ["n"])
    assert rows(decided, "prospect_id", "persona", "persona_certainty", "skip_reason") == [
        ("1", "Data User", "9", None),
        ("2", "Data User", "8", None),
        ("3", "Data User", "6", None),
        ("4", "Economic Buyer", "5", None),
        ("5", None, None, "No LLM response"),
        ("6", "Wizard", "4", "Invalid persona: Wizard"),
        ("7", None, None, "No LLM response"),
        ("8", "Not a target", "2", None),
    ]
    assert decided.columns.count("job_title") == 1


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=12),
    st.lists(st.tuples(st.sampled_from("abcdefghx"), st.sampled_from([*S.PERSONAS, "Data Users", "Wizard", "", None])), min_size=1, max_size=25),
)
def test_every_id_is_decided_once(spark, ids, answers):
    given_replies = replies(spark, [(i, n, p, "1") for n, (i, p) in enumerate(answers)])
    decided = D.decide(contacts(spark, ids), tidy_replies(given_replies), ["n"])
    yes, no = rows(D.accepted(decided), "prospect_id"), rows(D.skipped(decided), "prospect_id")
    assert sorted(yes + no) == sorted((i,) for i in set(ids))
    assert {r.persona for r in D.accepted(decided).collect()} <= set(S.PERSONAS)
    hopeful = {i for i, p in answers if p in S.PERSONAS or p == "Data Users"} & set(ids)
    assert {i for (i,) in yes} == hopeful


def test_batch_error_reaches_the_reason(spark):
    results = spark.createDataFrame(
        [("1", 1, None, None, "HTTP 429: slow"), ("2", 1, "Data User", "9", None)],
        "prospect_id string, line_no int, persona string, persona_certainty string, error string",
    )
    decided = D.decide(contacts(spark, "123"), results, ["line_no"], batch=True)
    assert rows(decided, "prospect_id", "skip_reason") == [
        ("1", "Batch error: HTTP 429: slow"), ("2", None), ("3", "Batch error: No LLM response")
    ]


def test_update_skipped_keeps_repeated_ids(spark):
    skipped = spark.createDataFrame(
        [("1", "a", None, None, "x"), ("1", "b", "Wizard", "3", "x"), ("2", "c", None, None, "x")],
        "prospect_id string, email string, persona string, persona_certainty string, skip_reason string",
    )
    results = spark.createDataFrame(
        [("1", " ", "5", None), ("2", None, None, "HTTP 500: {}")],
        "prospect_id string, persona string, persona_certainty string, error string",
    )
    for limits in ({}, {"max_rows": 0, "hot_rows": 1}):
        updated = D.update_skipped(skipped, results, **limits)
        assert rows(updated, "prospect_id", "email", "persona", "persona_certainty", "skip_reason") == [
            ("1", "a", None, "5", "Batch error: No LLM response"),
            ("1", "b", "Wizard", "5", "Invalid persona: Wizard"),
            ("2", "c", None, None, "Batch error: HTTP 500: {}"),
        ]


def test_remaining(spark):
    ids = lambda text: spark.createDataFrame([(c,) for c in text], "prospect_id string")
    assert rows(remaining_ids(ids("abcd"), ids("ab"), ids("bz"))) == [("b",), ("c",), ("d",), ("z",)]


def test_reports(spark):
    decided = spark.createDataFrame(
        [("Data User", None)] * 3 + [("Not a target", None)] + [("x", "Invalid persona: x")] * 2, "persona string, skip_reason string"
    )
    assert rows(report.persona_distribution(D.accepted(decided))) == [("Data User", 3, 75.0), ("Not a target", 1, 25.0)]
    assert rows(report.reason_counts(decided)) == [("Invalid persona: x", 2)]
    assert rows(report.run_summary(decided)) == [(6, 4, 2)]


def test_eta(spark):
    jobs = spark.createDataFrame(
        [(10, 0, 20, 100), (0, 0, 20, 100), (None, None, None, 100), (5, 5, None, None), (5, 5, 0, 190)],
        "completed long, failed long, given_total long, started_at long",
    )
    got = [(r.total, r.eta_seconds, r.eta_text) for r in report.with_eta(jobs, F.lit(200)).collect()]
    assert got == [(20, 100.0, "1m 40s"), (20, None, "—"), (0, None, "—"), (10, None, "—"), (10, 10.0, "10s")]


def test_contacts_are_shuffled_once(spark):
    given = contacts(spark, ["1", "2", None, " ", ""]).withColumn("prospect_id", F.col("prospect_id"))
    answers = replies(spark, [("1", 1, "Data User", "9"), (" ", 1, "Data User", "9"), ("", 1, "Data User", "9")])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        decided = D.decide(given, tidy_replies(answers), ["n"], threshold=None)
        plan = plan_of(decided)
        assert plan.count("Exchange hashpartitioning(_key") == 1 and plan.count("Exchange hashpartitioning") == 2
        assert rows(decided, "prospect_id", "persona", "seq") == [("", None, 4), (" ", None, 3), ("1", "Data User", 0), ("2", None, 1), (None, None, 2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
