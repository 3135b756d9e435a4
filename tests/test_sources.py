import zipfile

import pytest

from helpers import rows
from rolecast import schema as S
from rolecast.operators import clean
from rolecast.sinks.outputs import save_outputs, write_csv
from rolecast.sources import contacts as C
from rolecast.sources.archive import choose_member
from rolecast.sources.text import read_instructions, read_lines
from rolecast.streaming.intake import take_in

CSV = (
    "Record ID,Email,Job Title,Extra\n"
    '12345678901,a@x,"VP, ""Sales""",1\n'
    '2,,"two\nlines",2\n'
    "3,nan,None,NA\n"
)


def test_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(CSV)
    df = C.read_contacts(spark, f'"{path}"')
    assert df.columns == ["prospect_id", "email", "job_title", "Extra"]
    assert rows(df) == [
        ("12345678901", "a@x", 'VP, "Sales"', "1"), ("2", "", "two\nlines", "2"), ("3", "", "", "NA")
    ]


def test_id_is_renamed_only_when_absent(spark):
    both = spark.createDataFrame([("1", "2")], "record_id string, prospect_id string")
    assert clean.rename_id(both).columns == ["record_id", "prospect_id"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("00123", ' "q", ', "line\nbreak", None), ("99999999999999999999", "", " pad ", "x")],
        "prospect_id string, email string, job_title string, skip_reason string",
    )
    for quote_all in (True, False):
        path = str(tmp_path / f"out-{quote_all}")
        write_csv(df, path, quote_all)
        assert rows(C.read_csv_contacts(spark, path)) == rows(df.fillna(""))


def test_outputs(spark, tmp_path):
    decided = spark.createDataFrame(
        [("1", "a", "t", "Data User", "9", None), ("2", "b", "t", None, None, "No LLM response")],
        ", ".join(f"{c} string" for c in S.DECISION_COLUMNS),
    )
    yes, no = save_outputs(decided, str(tmp_path), "2025-01-02 03 04 05")
    assert yes.endswith("Personas 2025-01-02 03 04 05")
    assert no.endswith("Skipped prospects/Skipped prospects 2025-01-02 03 04 05")
    files = (tmp_path / "Skipped prospects" / "Skipped prospects 2025-01-02 03 04 05").glob("*.csv")
    lines = {line for file in files for line in file.read_text().splitlines()}
    assert lines == {
        '"Prospect Id","Email","Job Title","Persona","Persona Certainty","Skip Reason"',
        '"2","b","t","","","No LLM response"',
    }
    assert rows(clean.keep_without_persona(C.read_skipped(spark, no)), "prospect_id", "persona") == [("2", None)]
    again, _ = save_outputs(decided, str(tmp_path), "2025-01-02 03 04 05", rerun=True)
    assert again.endswith("Personas Rerun 2025-01-02 03 04 05")


@pytest.mark.parametrize(
    "names, chosen",
    [
        (["hubspot-export-summary.csv", S.ARCHIVE_MEMBER, "contacts.csv"], S.ARCHIVE_MEMBER),
        (["a.csv", "my-contacts-1.csv", "contacts-summary.csv"], "my-contacts-1.csv"),
        (["Summary.csv", "data.csv", "notes.txt"], "data.csv"),
        (["a.csv", "My Contact list.csv"], "My Contact list.csv"),
        (["a.csv", "Contacts.csv"], "Contacts.csv"),
    ],
)
def test_archive_member(names, chosen):
    assert choose_member(names) == chosen


@pytest.mark.parametrize("names", [["a.csv", "b.csv"], ["x-summary.csv"], []])
def test_archive_without_a_clear_member(names):
    with pytest.raises(ValueError):
        choose_member(names)


def test_archive_file(spark, tmp_path):
    for number in (1, 2):
        with zipfile.ZipFile(tmp_path / f"export{number}.zip", "w") as archive:
            archive.writestr("summary.csv", "x\n1\n")
            archive.writestr(S.ARCHIVE_MEMBER, CSV.replace("12345678901", f"{number}000"))
    df = C.read_contacts(spark, str(tmp_path / "*.zip"))
    assert rows(df.filter("email <> ''"), "prospect_id", "job_title", "row_no") == [
        ("1000", 'VP, "Sales"', 0), ("2000", 'VP, "Sales"', 0)
    ]
    assert df.count() == 6


def test_dispatch_errors(spark):
    for uri in ("x.xlsx", "x.txt"):
        with pytest.raises(ValueError):
            C.read_contacts(spark, uri)


def test_sheets(spark):
    a = spark.createDataFrame([("1", "x")], "prospect_id string, company string")
    b = spark.createDataFrame([("2",)], "prospect_id string")
    assert rows(C.concat_sheets({"A": a, "B": b, S.SUMMARY_SHEET: a})) == [("1", "x"), ("2", None)]
    with pytest.raises(ValueError):
        C.concat_sheets({S.SUMMARY_SHEET: a})


def test_text(spark, tmp_path):
    (tmp_path / "frame.txt").write_text("Frame.\n")
    (tmp_path / "personas.txt").write_text("Personas ü.")
    assert read_instructions(spark, str(tmp_path / "frame.txt"), str(tmp_path / "personas.txt")) == "Frame.\nPersonas ü."
    (tmp_path / "lines.jsonl").write_text('{"a":1}\n\n  \nbad\n')
    assert rows(read_lines(spark, str(tmp_path / "lines.jsonl")), "line") == [("bad",), ('{"a":1}',)]


def test_guards(spark):
    df = spark.createDataFrame([], "email string")
    with pytest.raises(ValueError):
        clean.require_rows(df)
    with pytest.raises(ValueError, match="persona"):
        clean.require_columns(df, ("email", "persona"))


def test_filters(spark):
    df = spark.createDataFrame(
        [("1", f"a{S.INTERNAL_MARKER}.com", "x"), ("2", "a@statestreet.com", "x"), ("3", None, "x"), ("4", f"a{S.INTERNAL_MARKER.upper()}.com", "x"), ("5", "b@x", "  ")],
        "prospect_id string, email string, job_title string",
    )
    assert rows(clean.prepare_contacts(df), "prospect_id") == [("2",), ("3",), ("4",)]
    assert rows(clean.drop_matching(df), "prospect_id") == [("3",), ("4",), ("5",)]
    kept = clean.prepare_contacts(df.selectExpr("*", "'c' as company"), keep_columns=["company"])
    assert kept.columns == ["prospect_id", "email", "job_title", "company"]


def test_intake(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    where = (str(drop), str(tmp_path / "out"), str(tmp_path / "state"))
    header = "Record ID,Email,Job Title\n"
    (drop / "one.csv").write_text(header + '1,a@x,"CTO, EU"\n2,b@x,\n')
    take_in(spark, *where)
    take_in(spark, *where)
    (drop / "two.csv").write_text(header + "3,c@x,Dev\n")
    take_in(spark, *where)
    assert rows(spark.read.parquet(where[1]), "prospect_id", "job_title") == [("1", "CTO, EU"), ("3", "Dev")]


def test_archives_and_batches_of_long_cells_are_bounded(spark, tmp_path, monkeypatch):
    """Long cells are packed into several archives and unpacked in several batches, as whole as they were."""
    import pandas as pd

    from catalogue import source_queries as Q
    from rolecast.sources import archive as A

    monkeypatch.setattr(Q, "ARCHIVE_CHARS", 200_000, raising=False)
    texts = ['a "b", c', "line\nbreak", None, "x" * 140_000, "", "y"]
    batch = pd.DataFrame({"Record ID": [str(i) for i in range(6)], "Job Title": texts, "Lead Language": ["en", None] * 3})
    packed = list(Q._pack_files(str(tmp_path))(iter([batch])))
    assert len(packed) > 1
    times = [1 + Q.LONG // max(1, len(text or "")) for text in texts]
    read = A.read_archives(spark, str(tmp_path)).select("prospect_id", "job_title", "Lead Language").collect()
    assert sorted(map(tuple, read)) == [(str(i), (text or "") * times[i], "" if i % 2 else "en") for i, text in enumerate(texts)]
    monkeypatch.setattr(A, "CHARS_PER_BATCH", 10)
    rows = iter([["1", "a" * 8], ["2", "b"], ["3", "c"]])
    assert [len(A._some_rows(rows)) for _ in range(3)] == [2, 1, 0]
