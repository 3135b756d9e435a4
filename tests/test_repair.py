import difflib

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import rows
from rolecast import schema as S
from rolecast.functions.similarity import closest_name_by_edits
from rolecast.operators import repair

GOLDEN = {
    "Economic buyer": "Economic Buyer",
    "economic buyer": "Economic Buyer",
    "Exec Sponsor": "Executive Sponsor",
    "Developer": "Application Developer",
    "Real-Time Specialist": "Real-time Specialist",
    "Data Users": "Data User",
    "Technical User": "Technical Decision Maker",
    "System Administrator": "Operator/Systems Administrator",
    "Executive": "Executive Sponsor",
    "Business Beneficiary": None,
    "Architect": None,
    "IT Manager": None,
    "NOT A TARGET": None,
    "nan": None,
}


def replies(spark, words):
    return spark.createDataFrame([(str(i), i, w) for i, w in enumerate(words)], "prospect_id string, n int, persona string")


def test_golden(spark):
    got = {r.persona: r.repaired for r in repair.with_repairs(replies(spark, GOLDEN), ["n"]).collect()}
    assert got == GOLDEN


def test_valid_and_missing_are_left_alone(spark):
    tried = repair.with_repairs(replies(spark, ["Data User", None]), ["n"])
    assert [r.repaired for r in tried.collect()] == [None, None]


def test_salted_path_gives_the_same_rows(spark):
    words = ["Economic buyer"] * 300 + ["Wizard"] * 50 + [None] * 20 + list(GOLDEN)
    small = repair.with_repairs(replies(spark, words), ["n"])
    large = repair.with_repairs(replies(spark, words), ["n"], max_rows=0, hot_rows=10)
    assert rows(small, "prospect_id", "persona", "repaired") == rows(large, "prospect_id", "persona", "repaired")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aeicoDEUsrdtn -/", min_size=1, max_size=20).map(str.strip).filter(bool), max_size=30))
def test_against_brute_force(spark, words):
    words = words + ["Data Usr", "Ecomic Buyer"]
    got = {r.persona: r.repaired for r in repair.with_repairs(replies(spark, words), ["n"]).collect()}
    for word in words:
        best = difflib.get_close_matches(word, S.PERSONAS, 1, 0.6) if word not in S.PERSONAS else []
        assert got[word] == (best[0] if best else None)


def test_by_edits_needs_no_python(spark):
    df = spark.createDataFrame([("Data Users",), ("Wizard",)], "w string")
    scored = df.select("w", closest_name_by_edits(F.col("w")).alias("name"))
    assert rows(scored) == [("Data Users", "Data User"), ("Wizard", None)]
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()


def test_repair_skipped(spark):
    skipped = spark.createDataFrame(
        [("1", "Data Users", "Invalid persona: Data Users"), ("2", "Wizard", "Invalid persona: Wizard"),
         ("3", "Data Users", "Batch error: x"), ("4", None, "No LLM response")],
        "prospect_id string, persona string, skip_reason string",
    )
    corrected, still = repair.repair_skipped(skipped)
    assert rows(corrected) == [("1", "Data User", None)]
    assert rows(still) == rows(skipped.filter("prospect_id <> '1'"))


def test_only_distinct_words_are_scored(spark, tmp_path):
    path = str(tmp_path / "replies")
    replies(spark, ["Data Users"] * 50 + ["Data User"]).write.parquet(path)
    tried = repair.with_repairs(spark.read.parquet(path), ["n"])
    plan = tried._jdf.queryExecution().executedPlan().toString()
    scored = plan[plan.index("ArrowEvalPython"):]
    read = scored.split("FileScan")[1]
    assert "ReadSchema: struct<word:string>" in read and path not in read
