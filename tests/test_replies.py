from pyspark.sql import functions as F

from helpers import plan_of, rows
from rolecast.operators import replies as R
from rolecast.plans.batch import batch_results, finish_batch

LINES = [
    ("1,a,Data User,9", ("1", "a", "Data User", "9", "ok")),
    ("1,a,P,9,extra", ("1", "a", "P", "9", "long")),
    ("1,a,P,,extra", ("1", "a", "P", None, "long")),
    ("1,a,P", ("1", "a", "P", None, "short")),
    ("```csv", ("```csv", None, None, None, "short")),
    ('1,"a,b",P,9', ("1", "a,b", "P", "9", "ok")),
    ('1,"a ""b""",P,9', ("1", 'a "b"', "P", "9", "ok")),
    ("1,a, P ,9", ("1", "a", " P ", "9", "ok")),
    (",a,P,9", (None, "a", "P", "9", "ok")),
    ("1,a,NA,9", ("1", "a", "NA", "9", "ok")),
    ("Prospect Id,Job Title,Persona,Persona Certainty", ("Prospect Id", "Job Title", "Persona", "Persona Certainty", "ok")),
]


def test_reply_lines(spark):
    text = "\r\n".join(line for line, _ in LINES) + "\n\n   \n"
    parsed = R.parse_reply_lines(spark.createDataFrame([(1, text)], "chunk_id long, reply string"))
    got = [tuple(r)[2:] for r in parsed.orderBy("line_no").collect()]
    assert got == [want for _, want in LINES]


def test_unbalanced_quote_spoils_its_own_line_only(spark):
    reply = '1,"a,P,9\n2,b,Data User,8'
    parsed = R.parse_reply_lines(spark.createDataFrame([(1, reply)], "chunk_id long, reply string"))
    assert rows(parsed.filter("line_no = 1"), "prospect_id", "persona") == [("2", "Data User")]


def test_lines_of_very_many_commas(spark):
    title = ", ".join(f"VP{i}" for i in range(2_000))
    marked = title.replace("VP7,", '""VP7"",')
    lines = [
        (f'1,"{title}",CEO,0.9', ("1", title, "CEO", "0.9", "ok")),
        (f'2,"{marked}",CEO,0.9', ("2", marked.replace('""', '"'), "CEO", "0.9", "ok")),
        (f'3,CEO,"{title}"', ("3", "CEO", title, None, "short")),
        (f'4,"{title}",CEO,0.9,"{title}"', ("4", title, "CEO", "0.9", "long")),
        ("5,a,P,9" + ",x" * 25_000, ("5", "a", "P", "9", "long")),
        ("6,,P," + "," * 25_000, ("6", None, "P", None, "long")),
        ("7,b,P,8", ("7", "b", "P", "8", "ok")),
    ]
    reply = "\n".join(line for line, _ in lines)
    parsed = R.parse_reply_lines(spark.createDataFrame([(1, reply)], "chunk_id long, reply string"))
    assert [tuple(r)[2:] for r in parsed.orderBy("line_no").collect()] == [want for _, want in lines]


def test_tidy(spark):
    df = spark.createDataFrame([(p,) for p in (" P ", "NA", "nan", "null", "", None, "na")], "persona string")
    got = [r[0] for r in R.tidy_replies(df.withColumn("persona_certainty", F.lit(" 9% "))).select("persona").collect()]
    assert got == ["P", None, None, None, None, None, "na"]


def body(content):
    return '{"custom_id":"%s","response":{"status_code":200,"body":{"choices":[{"message":{"content":%s}}]}}}'


ENVELOPES = [
    (body(0) % ("1", '"{\\"persona\\": \\" Data User \\", \\"certainty\\": 92}"'), ("1", "Data User", "92", None)),
    (body(0) % ("2", '"{\\"persona\\": \\"Data User\\", \\"certainty\\": \\"90%\\"}"'), ("2", "Data User", "90%", None)),
    ('{"custom_id":"3","response":{"status_code":429,"body":{"error":{"message":"slow"}}}}', ("3", None, None, "HTTP 429: slow")),
    ('{"custom_id":"4","response":{"status_code":500}}', ("4", None, None, "HTTP 500: {}")),
    ('{"custom_id":"5","response":{"status_code":200,"body":{}}}', ("5", None, None, "Malformed success body: {}")),
    (body(0) % ("6", '"```json {}"'), ("6", None, None, "Invalid JSON: ```json {}")),
    (body(0) % ("7", '"{\\"persona\\": null}"'), ("7", None, None, None)),
    ('{"custom_id":"8","response":null}', ("8", None, None, "HTTP 0: {}")),
    ("not json", ("", None, None, "Invalid JSON: not json")),
    ("[1]", ("", None, None, "Invalid JSON: [1]")),
    ('{"response":{"status_code":500,"body":{"error":"plain"}}}', ("", None, None, 'HTTP 500: {"error":"plain"}')),
    (body(0) % ("9", '"[1, 2]"'), ("9", None, None, "Invalid JSON: [1, 2]")),
    (body(0) % ("10", '"{\\"persona\\": \\"Data User\\"} and more"'), ("10", None, None, 'Invalid JSON: {"persona": "Data User"} and more')),
    (body(0) % ("11", '"{\'persona\': \'Data User\'}"'), ("11", None, None, "Invalid JSON: {'persona': 'Data User'}")),
    ('{"custom_id":"12","response":{"status_code":503,"body":"down"}}', ("12", None, None, "HTTP 503: down")),
    ('{"custom_id":13,"response":{"status_code":"200","body":{"choices":[]}}}', ("13", None, None, 'Malformed success body: {"choices":[]}')),
]


def test_envelopes(spark):
    lines = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(ENVELOPES)], "line_no int, line string")
    parsed = R.parse_persona_objects(R.parse_envelopes(lines, keep=("line_no",))).orderBy("line_no")
    got = [(r.prospect_id, r.persona, r.persona_certainty, r.error) for r in parsed.collect()]
    assert got == [want for _, want in ENVELOPES]


def test_last_result_wins_over_later_error(spark):
    good = body(0) % ("1", '"{\\"persona\\": \\"Data User\\"}"')
    better = body(0) % ("1", '"{\\"persona\\": \\"Not a target\\"}"')
    failed = '{"custom_id":"1","response":{"status_code":500}}'
    lines = spark.createDataFrame([(1, good), (2, better), (3, failed)], "line_no int, line string")
    assert rows(batch_results(lines), "prospect_id", "persona", "error") == [("1", "Not a target", None)]


def test_first_and_best(spark):
    df = spark.createDataFrame(
        [("1", 2, "Data User", None), ("1", 1, "Wizard", None), ("1", 3, "Not a target", None),
         ("2", 1, "x", None), ("2", 2, "Developer", "Application Developer"), ("3", 5, "y", None), ("3", 4, None, None)],
        "prospect_id string, n int, persona string, repaired string",
    )
    assert rows(R.first_per_id(df, ["n"]), "prospect_id", "persona") == [("1", "Wizard"), ("2", "x"), ("3", None)]
    assert rows(R.best_per_id(df, ["n"]), "prospect_id", "persona") == [
        ("1", "Data User"), ("2", "Developer"), ("3", None)
    ]


def test_lines_are_parsed_once(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([(1, ENVELOPES[0][0])], "line_no int, line string").write.parquet(path)
    contacts = spark.createDataFrame([("1", "e", "t", 1)], "prospect_id string, email string, job_title string, seq long")
    decided = finish_batch(contacts, spark.read.parquet(path), threshold=None)
    assert rows(decided, "prospect_id", "persona") == [("1", "Data User")]
    assert plan_of(decided).count("from_json(StructField(custom_id") == 1


def test_plans_stay_in_the_jvm(spark):
    lines = spark.createDataFrame([(1, "x")], "line_no int, line string")
    for df in (batch_results(lines), R.parse_reply_lines(spark.createDataFrame([(1, "x")], "chunk_id int, reply string"))):
        assert "Python" not in plan_of(df) and "ArrowEval" not in plan_of(df)


def test_lines_are_looked_through_once(spark):
    """One look for the fifth cell of a line, and line ends as before: a carriage return belongs
    to the line feed after it, others to their line."""
    made = spark.createDataFrame([(1, "1,a,b,9\r\n2,c,d,8\n\r\r\n3,e,f,7\r"), (2, None), (3, "")], "chunk_id long, reply string")
    parsed = R.parse_reply_lines(made)
    assert plan_of(parsed).count("regexp_extract(") == 1
    found = sorted((row["line_no"], row["prospect_id"], row["persona_certainty"]) for row in parsed.filter("prospect_id is not null").collect())
    assert [(number, cell) for number, cell, _ in found] == [(0, "1"), (1, "2"), (3, "3")]


def test_output_files_take_less_disk_than_their_lines(spark, tmp_path):
    """Files of output lines are packed, and the later file still wins."""
    from pathlib import Path

    from catalogue.reply_queries import rep_last_files
    from rolecast.session import run_dir

    item = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    made = [(order, 1, line, 7.0, 0.06 if line < 5 else 0.03, 0.0, "A", "F") for order in range(40) for line in range(1, 6)]
    spark.createDataFrame(made, item).write.parquet(f"{tmp_path}/lineitem.parquet")
    files = lambda: {path for path in Path(run_dir(spark)).rglob("part=*/part-*")}
    before = files()
    found = rep_last_files(spark, str(tmp_path)).collect()
    assert sorted(row["prospect_id"] for row in found) == sorted(str(order) for order in range(40))
    assert all("Data User" in row["content"] for row in found)
    assert sum(path.stat().st_size for path in files() - before) < 20_000  # 34,400 of padding alone


def test_long_cells_are_not_looked_through_by_patterns(spark, monkeypatch):
    """A line that the parser takes is parsed whole; its shape is that of the line up to its fifth cell."""
    title = ", ".join(["VP"] * 1_100)
    lines = [
        (f'1,"{title}",CEO,0.9', ("1", title, "ok")),
        (f'2,"{title}",CEO,0.9,note, more', ("2", title, "long")),
        (f'3,5" disk,CEO,0.9,note,{title},"x"', ("3", '5" disk', "long")),
        (f'4,x"y,z"w,CEO,0.9{",a" * 1_100}', ("4", 'x"y', "short")),
        (f'5,"{title},CEO,0.9', ("5", f"{title},CEO,0.9", "long")),
        (f'"6","a ""b"", c","","0.9",{title}', ("6", 'a "b", c', "long")),
    ]
    made = spark.createDataFrame([(line,) for line, _ in lines], "line string")
    assert all(len(line) < R.PARSED_BYTES for line, _ in lines)
    assert made.filter(R._first_cells(F.col("line")) != F.col("line")).count() == 0
    replies = spark.createDataFrame([(1, "\r\n".join(line for line, _ in lines))], "chunk_id long, reply string")
    for least in (R.PARSED_BYTES, 0):  # whole or cut, the cells are the same
        monkeypatch.setattr(R, "PARSED_BYTES", least)
        parsed = R.parse_reply_lines(replies).orderBy("line_no").collect()
        assert [(row["prospect_id"], row["job_title"], row["shape"]) for row in parsed] == [want for _, want in lines]
