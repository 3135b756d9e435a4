"""CSV files in blocks: every split of a file gives the records that a plain reader gives."""

import csv
import io
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import plan_of, rows
from rolecast.sources import csv_blocks as module
from rolecast.sources.csv_blocks import block_starts, csv_files, csv_lines, ends_inside, header_names, read_csv_by_name

CELLS = ["", "a", 'b"c', "x,y", "line\nbreak", '"q"', "two\n\nlines", "é\r\nü", ' 5" disk', '"', "\n", ",\n\"", "plain words"]


@pytest.fixture
def small_splits(spark):
    for name, value in (("maxPartitionBytes", "300"), ("openCostInBytes", "10")):
        spark.conf.set(f"spark.sql.files.{name}", value)
    yield
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(CELLS), min_size=2, max_size=4), min_size=1, max_size=6))
def test_line_states(table):
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(table)
    inside, records, held = False, [], []
    for line in text.getvalue().removesuffix("\n").split("\n"):
        held.append(line)
        inside = ends_inside(line.encode(), inside)
        if not inside:
            records.append("\n".join(held))
            held = []
    assert not held and [next(csv.reader(io.StringIO(record, newline=""))) if record else [] for record in records] == [
        row if row != [""] else [] for row in table
    ]


def test_quotes_inside_plain_cells():
    assert not ends_inside(b'1,5" disk,x', False) and not ends_inside(b'1,a"b"c"', False) and ends_inside(b'1,5" disk,"x', False)
    assert ends_inside(b'x,""y', True) and not ends_inside(b'x",y', True) and ends_inside(b'x",y,"z', True) and not ends_inside(b'x"tail,"z"', True)


def test_long_lines_take_linear_time():
    assert not ends_inside(b'"' + b'""' * 300_000 + b'"', False) and ends_inside(b'a,"' + b'""' * 300_000, False)
    assert ends_inside(b'"a",' * 200_000 + b'"', False)


def test_block_starts(spark):
    ways = {"same": (False, True), "turn": (True, False), "out": (False, False), "in": (True, True)}
    draw = random.Random(2)
    blocks, want = [], {}
    for file in range(8):
        inside = False
        for block in range(12):
            way = ways[draw.choice(list(ways))]
            blocks.append((file, block, "", *way))
            want[file, block] = inside
            inside = way[inside]
    df = spark.createDataFrame(blocks, module.BLOCKS).repartition(3)
    assert {(r.file, r.block): r.inside for r in block_starts(df).collect()} == want


def written(folder, n=400):
    draw = random.Random(5)
    table = [[str(i), *[draw.choice(CELLS) for _ in range(3)]] for i in range(n)]
    with open(folder / "a.csv", "w", newline="") as file:
        csv.writer(file).writerows([["Record ID", "A", "B", "C"], *table[: n // 2]])
    with open(folder / "b c.csv", "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows([["c", "Record ID", "D"], *[[row[3], row[0], "d"] for row in table[n // 2 :]]])
    first = [(row[0], *[cell or None for cell in row[1:]], None) for row in table[: n // 2]]
    return sorted(first + [(row[0], None, None, row[3] or None, "d") for row in table[n // 2 :]])


@pytest.mark.parametrize("shuffled", [False, True])
def test_records_across_blocks(spark, tmp_path, small_splits, monkeypatch, shuffled):
    want = written(tmp_path)
    if shuffled:
        monkeypatch.setattr(module, "BROADCAST_BLOCKS", 0)
    lines = csv_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    got = read_csv_by_name(spark, str(tmp_path))
    assert sorted((r["Record ID"], r["A"], r["B"], r["C"], r["D"]) for r in got.collect()) == want


def test_plain_files_stay_out_of_python(spark, tmp_path, small_splits):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text("\ufeffRecord ID,Email,Email\n" + "".join(f"{i},{name}{i}@x,\"q, {i}\"\n" for i in range(50)) + "Record ID,Email,Email\n\n  \n9,short\n")
    got = read_csv_by_name(spark, str(tmp_path))
    assert "MapInArrow" not in plan_of(got)
    assert got.columns == ["Record ID", "Email", "Email2"] and got.count() == 104
    assert got.filter("Email = 'a7@x'").first()["Email2"] == "q, 7"
    assert rows(got.filter("`Record ID` = 'Record ID'"), "Email") == [("Email",), ("Email",)]
    assert rows(got.filter("Email = 'short'"), "Email2") == [(None,), (None,)]


def test_files_of_both_kinds(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Record ID,"Job\nTitle"\n1,"b\nc"\n')
    (tmp_path / "b.csv").write_text("Record ID,Email\n2,x\n3,y\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("Record ID,Email\n")
    got = read_csv_by_name(spark, str(tmp_path))
    assert sorted(tuple(row) for row in got.select("Record ID", "Job\nTitle", "Email").fillna("").collect()) == [("1", "b\nc", ""), ("2", "", "x"), ("3", "", "y")]
    assert csv_files(csv_lines(spark, str(tmp_path))).filter("broken").count() == 1


def test_empty_files(spark, tmp_path):
    (tmp_path / "c.csv").write_text("")
    assert read_csv_by_name(spark, str(tmp_path)).count() == 0


def test_header_names():
    assert header_names('a,"b, c",,A,a\r') == ["a", "b, c", "_c2", "A3", "a4"]


def test_rounds_of_wide_files_leave_no_files(spark, tmp_path, monkeypatch):
    """Files of earlier rounds are gone, and no document is lost or told twice."""
    from pathlib import Path

    from catalogue import source_queries as Q
    from rolecast.session import run_dir

    texts = ["one", 'two "quoted"\nlines', "", None] + [f"text {i}" for i in range(20)] + ["same"] * 3
    made = [(i, None if i == 5 else "web", text) for i, text in enumerate(texts)] + [(None, "web", "no id")]
    spark.createDataFrame(made, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(Q, "ROUND_BYTES", 700_000)
    files = lambda: {str(path) for path in Path(run_dir(spark)).rglob("*.csv")}
    before = files()
    found = {row["prospect_id"]: (row["company"], row["n_chars"]) for row in Q.src_csv_split(spark, str(tmp_path)).collect()}
    assert files() == before
    assert len(found) == len(made)
    for doc_id, source, text in made:
        unit = len(text or "") + 8
        assert found["" if doc_id is None else str(doc_id)] == (source or "", unit * (1 + 40_000 // (10 + len(text or ""))))


def test_first_look_sorts_no_lines(spark, tmp_path):
    written(tmp_path)
    plan = plan_of(csv_files(csv_lines(spark, str(tmp_path))))
    assert "Sort" not in plan and "ObjectHashAggregate" in plan


def test_rounds_are_bounded_and_all_cores_write(spark, tmp_path, monkeypatch):
    """Large tables have larger rounds, not more, and their files are as many as cores."""
    from catalogue import source_queries as Q

    spark.createDataFrame([(i, "web", f"text {i}") for i in range(60)], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(Q, "ROUND_BYTES", 200_000)
    monkeypatch.setattr(Q, "ROUNDS", 2, raising=False)
    monkeypatch.setattr(Q, "FILE_BYTES", 100_000, raising=False)
    parts, write = [], Q.write_csv
    monkeypatch.setattr(Q, "write_csv", lambda rows, path: parts.append(plan_of(rows)) or write(rows, path))
    assert Q.src_csv_split(spark, str(tmp_path)).count() == 60
    cores = spark.sparkContext.defaultParallelism
    assert len(parts) == 2 and all(f"Coalesce {cores}" in plan for plan in parts)


def test_long_records_in_small_batches(spark):
    """Records over many Arrow batches, with and without quotes, whatever the edges of batches."""
    import pyarrow as pa

    draw = random.Random(9)
    lines = [draw.choice(["1,plain", "", '2,"open', 'x ""y"" z', 'end",3', '4,"a ""b""",c', '5,5" disk']) for _ in range(300)]
    want, held, inside, first = [], [], True, 0
    for number, line in enumerate(lines):
        first = first if held else number
        held.append(line)
        inside = ends_inside(line.encode(), inside)
        if not inside:
            want.append((first, "\n".join(held)))
            held = []
    want += [(first, "\n".join(held))] if held else []
    for step in (1, 7, 300):
        batches = [
            pa.RecordBatch.from_pydict({"value": part, "file": [1] * len(part), "block": [5] * len(part), "inside": [True] * len(part)})
            for part in (lines[at : at + step] for at in range(0, len(lines), step))
        ]
        got = [row for batch in module.put_together(iter(batches)) for row in batch.to_pylist()]
        assert [(row["line"], row["record"]) for row in got] == want and got[0]["kind"] == "more"
        looked = next(module.look_at_blocks(iter(batches))).to_pylist()
        assert len(looked) == 1 and looked[0]["if_inside"] == inside
