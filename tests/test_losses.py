"""Rows, cells and order that must not get lost."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from rolecast import schema as S, session
from rolecast.operators.decide import decide, update_skipped
from rolecast.operators.repair import repair_table, with_repairs
from rolecast.operators.replies import last_results, parse_envelopes, parse_reply_lines
from rolecast.plans.batch import finish_batch
from rolecast.session import end_run, new_path, saved
from rolecast.sources.archive import distinct_names, read_archives
from rolecast.sources.contacts import CrmTables, read_contacts, read_csv_contacts
from rolecast.sources.crm import report_contacts
from rolecast.sources.text import read_lines
from rolecast.streaming.intake import take_in

CONTACT = "prospect_id string, seq long, email string, job_title string"


def crm(spark, n):
    ids = spark.range(n).select(F.col("id").cast("string").alias("id"))
    blank = F.struct(*[F.lit("").alias(name) for name in ("hs_object_id", "email", "jobtitle", "firstname", "lastname", "company")])
    contacts = ids.select("id", blank.alias("properties"))
    members = ids.select(F.when(F.length("id") < 9, "5").otherwise("6").alias("list_id"), F.col("id").alias("contact_id"), F.lit("").alias("record_id"))
    return CrmTables(contacts, members, spark.createDataFrame([("9", "5")], "report_id string, list_id string"))


@pytest.mark.parametrize("uri", ["list:5", "hubspot:9"])
def test_no_cap_unless_asked_for(spark, uri):
    tables = crm(spark, 12_000)
    assert read_contacts(spark, uri, tables).count() == 12_000
    assert read_contacts(spark, uri, tables, limit=10).count() == 10


def test_a_hot_list_is_not_one_task(spark):
    tables = crm(spark, 10)
    plan = plan_of(report_contacts(tables.contacts, tables.memberships, tables.report_lists, "9"))
    assert "BroadcastHashJoin [list_id" in plan and "SortMergeJoin [list_id" not in plan


def test_long_lines_and_contents_stay_whole(spark):
    line = "not json " * 60
    lines = spark.createDataFrame([(line, 1)], "line string, line_no int")
    assert parse_envelopes(lines).first().error == f"Invalid JSON: {line}"


def test_a_line_of_very_many_cells(spark):
    wide = "1,a,Data User,80" + "," * 25_000
    quoted = '2,"x, y",Data User,70,' + "b," * 3_000
    got = parse_reply_lines(spark.createDataFrame([(7, f"{wide}\n{quoted}\n3,b,Data User,60")], "chunk_id long, reply string"))
    assert rows(got, "prospect_id", "job_title", "persona_certainty", "shape") == [("1", "a", "80", "long"), ("2", "x, y", "70", "long"), ("3", "b", "60", "ok")]


def zipped(path, text):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        archive.writestr(S.ARCHIVE_MEMBER, text)
    path.write_bytes(packed.getvalue())


def test_archives_keep_all_cells(spark, tmp_path):
    zipped(tmp_path / "a.zip", f"Record ID,Email,Job Title,Region,Region\n1,a@x,{'t' * 200_000},north,south\n2,b@x,VP, Sales,e,f,more\n3\n")
    zipped(tmp_path / "b.zip", "Job Title,Prospect Id,Owner\nCEO,9,me\n")
    got = {r.prospect_id: r for r in read_archives(spark, str(tmp_path)).collect()}
    assert len(got["1"].job_title) == 200_000 and (got["1"].Region, got["1"]["Region (2)"], got["1"].surplus) == ("north", "south", None)
    assert (got["2"].job_title, got["2"].surplus) == ("VP", "f,more") and got["3"].email == ""
    assert (got["9"].job_title, got["9"].Owner, got["1"].Owner) == ("CEO", "me", "")
    assert distinct_names(["a", "a", "a"]) == ["a", "a (2)", "a (3)"]


def test_csv_columns_by_name(spark, tmp_path):
    folder = tmp_path / "some files"
    folder.mkdir()
    (folder / "a.csv").write_text('Record ID,Email\n1,a@x\n2,"b\n@x"\n')
    (folder / "b.csv").write_text("Email,Extra,Record ID\nc@x,e,3\n")
    for got in (read_csv_contacts(spark, str(folder / "*.csv")), read_contacts(spark, f"{folder}/")):
        assert rows(got, "prospect_id", "email", "Extra") == [("1", "a@x", ""), ("2", "b\n@x", ""), ("3", "c@x", "e")]


def test_intake_by_name(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "a.csv").write_text("Record ID,First Name,Email,Job Title\n1,Ann,a@x,CEO\n")
    paths = [str(tmp_path / name) for name in ("drop", "out", "state")]
    take_in(spark, *paths, prepare=lambda df: df)
    assert rows(spark.read.parquet(paths[1]), "record_id", "email", "job_title") == [("1", "a@x", "CEO")]
    (drop / "b.csv").write_text("Record ID,Mail,Job Title\n2,b@x,CTO\n")
    with pytest.raises(Exception, match="missing columns: Email"):
        take_in(spark, *paths, prepare=lambda df: df)


def nameless(spark):
    return spark.createDataFrame([("", 1, "a@x", "CEO"), ("", 2, "b@x", "CTO"), (None, 3, "c@x", "CIO"), ("7", 4, "d@x", "VP"), ("7", 5, "e@x", "VP")], CONTACT)


def test_contacts_without_id(spark):
    replies = spark.createDataFrame([("7", 1, "Data User", "9"), ("", 2, "Data User", "9")], "prospect_id string, n int, persona string, persona_certainty string")
    got = decide(nameless(spark), replies, ["n"])
    assert rows(got, "seq", "persona", "skip_reason") == [(1, None, "No LLM response"), (2, None, "No LLM response"), (3, None, "No LLM response"), (4, "Data User", None)]
    lines = spark.createDataFrame([("connection closed", 1)], "line string, line_no int")
    reasons = {r.skip_reason for r in finish_batch(nameless(spark), lines).collect()}
    assert reasons == {"Batch error: No LLM response"}
    with pytest.raises(ValueError, match="seq"):
        decide(nameless(spark).drop("seq"), replies, ["n"])


def test_rerun_of_rows_without_id(spark):
    columns = "prospect_id string, email string, job_title string, persona string, persona_certainty string"
    skipped = spark.createDataFrame([("", "a@x", "CEO", None, None)], columns).withColumn("skip_reason", F.lit("x"))
    results = spark.createDataFrame([("", None, None, "Invalid JSON: y")], "prospect_id string, persona string, persona_certainty string, error string")
    assert update_skipped(skipped, results).first().skip_reason == "Batch error: No LLM response"


@pytest.mark.parametrize("size", ["1m", "64m"])
def test_the_later_file_wins(spark, tmp_path, size):
    def line(persona):
        return '{"custom_id":"1","response":{"status_code":200,"body":{"choices":[{"message":{"content":"' + persona + '"}}]}}}'

    (tmp_path / "part-0").write_text(line("first") + "\n")
    (tmp_path / "part-1").write_text("\n".join(['{"custom_id":"0"}'] * 100_000 + [line("second")]) + "\n")
    (tmp_path / "part-2").write_text(line("third") + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        envelopes = parse_envelopes(read_lines(spark, str(tmp_path)), keep=("line_no",))
        assert last_results(envelopes, ["line_no"]).filter("prospect_id = '1'").first().content == "third"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_each_word_is_scored_once(spark):
    replies = saved(spark.createDataFrame([("1", "Data Usr"), ("2", "zzz"), ("3", None)], "prospect_id string, persona string"), "replies")
    repaired = with_repairs(replies, ["prospect_id"])
    assert plan_of(repaired.filter("repaired is not null")).count("ArrowEvalPython") == 1
    assert rows(repaired, "prospect_id", "repaired") == [("1", "Data User"), ("2", None), ("3", None)]


def test_the_bound_loses_no_repair(spark):
    import difflib
    import random

    draw = random.Random(0)
    words = {"".join(draw.choices(list(name) + ["x"], k=draw.randint(1, len(name) + 6))) for name in S.PERSONAS for _ in range(60)}
    words |= {name[:i] + name[i + 1 :] for name in S.PERSONAS for i in range(0, len(name), 3)}
    got = {r.word: r.repaired for r in repair_table(spark.createDataFrame([(w,) for w in sorted(words)], "word string")).collect()}
    want = {w: next(iter(difflib.get_close_matches(w, S.PERSONAS, 1, 0.6)), None) for w in words}
    assert got == {w: name for w, name in want.items() if name}


def test_a_run_ends(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    table = saved(spark.range(3), "x")
    assert table.count() == 3 and new_path(spark, "y").startswith(str(tmp_path))
    end_run(spark)
    with pytest.raises(Exception):
        table.count()
