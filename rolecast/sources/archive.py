"""Contact tables inside zipped exports."""

from __future__ import annotations

import csv
import io
import sys
import zipfile
from collections.abc import Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecast import schema as S
from rolecast.operators.clean import clean_null_tokens, rename_id

HEADER_SCHEMA = "path string, name string, place int"
ROWS_SCHEMA = "path string, row_no long, cells array<string>, surplus string"
ROWS_PER_BATCH = 5_000
CHARS_PER_BATCH = 16_000_000
ID_COLUMNS = ("Prospect Id", "Record ID")
KNOWN_COLUMNS = ("Email", "Job Title", "First Name", "Last Name", "Company")


def choose_member(names: list[str]) -> str:
    """The contact table of an export: the usual name, else a name with `contacts`, else the
    only table, else one with `contact` in its name. Summaries never count."""
    tables = sorted(n for n in names if n.endswith(".csv") and "/" not in n)
    data = [n for n in tables if "summary" not in n.lower()]
    named = [n for n in data if "contacts" in n]
    close = [n for n in data if "contact" in n.lower()]
    if S.ARCHIVE_MEMBER in tables:
        return S.ARCHIVE_MEMBER
    if named:
        return named[0]
    if len(data) == 1:
        return data[0]
    if close:
        return close[0]
    if data:
        raise ValueError(f"cannot tell which table to use: {data}")
    raise ValueError("no contact table in the archive")


def distinct_names(header: Sequence[str]) -> list[str]:
    """Column names of a header; a name that comes again gets its number behind it."""
    found: list[str] = []
    for name in header:
        again = 2
        fresh = name
        while fresh in found:
            fresh = f"{name} ({again})"
            again += 1
        found.append(fresh)
    return found


def _tables(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Iterator[list[str]]]]:
    csv.field_size_limit(sys.maxsize)  # a title may be longer than the reader's default
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive, archive.open(choose_member(archive.namelist())) as stream:
                yield path, csv.reader(io.TextIOWrapper(stream, encoding="utf-8-sig", newline=""))


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for path, reader in _tables(batches):
        names = distinct_names(next(reader, []))
        yield pd.DataFrame({"path": path, "name": names, "place": range(len(names))})


def archive_columns(files: DataFrame) -> list[str]:
    """All column names of the archives: known ones first, the others by name."""
    found = {row.name for row in files.select("path", "content").mapInPandas(_headers, HEADER_SCHEMA).select("name").distinct().collect()}
    known = [name for name in (*ID_COLUMNS, *KNOWN_COLUMNS) if name in found]
    return known + sorted(found.difference(known))


def unpack_archives(files: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Contacts of archives given as `path`, `content`, with `path` and `row_no` of each row.

    Every column of the tables is handed on, found by name in each table; a column that a
    table lacks is empty. `columns` saves the reading of all headers beforehand. Cells beyond
    the header are kept, as one CSV text, in `surplus`, which is null for tidy rows. One
    archive is unpacked by one task and streamed on in small batches. What a task holds at a
    time is bounded by `spark.sql.files.maxPartitionBytes`, or by one archive if larger.
    """
    names = list(columns) if columns is not None else archive_columns(files)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path, reader in _tables(batches):
            header = distinct_names(next(reader, []))
            places = [header.index(name) if name in header else None for name in names]
            row_no = 0
            while part := _some_rows(reader):
                cells = [[row[p] if p is not None and p < len(row) else "" for p in places] for row in part]
                surplus = [_one_line(row[len(header) :]) if len(row) > len(header) else None for row in part]
                yield pd.DataFrame({"path": path, "row_no": range(row_no, row_no + len(part)), "cells": cells, "surplus": surplus})
                row_no += len(part)

    unpacked = files.select("path", "content").mapInPandas(rows, ROWS_SCHEMA)
    cell = {name: F.coalesce(F.get("cells", F.lit(i)), F.lit("")) for i, name in enumerate(names)}
    ids = [F.nullif(cell[name], F.lit("")) for name in ID_COLUMNS if name in cell]
    others = [name for name in names if name not in ID_COLUMNS and name not in KNOWN_COLUMNS]
    flat = unpacked.select(
        "path",
        "row_no",
        F.coalesce(*ids, F.lit("")).alias("prospect_id"),
        *[cell.get(name, F.lit("")).alias(S.DISPLAY_NAMES[name]) for name in KNOWN_COLUMNS],
        *[cell[name].alias(S.DISPLAY_NAMES.get(name, name)) for name in others],
        "surplus",
    )
    return clean_null_tokens(rename_id(flat))


def _some_rows(reader: Iterator[list[str]]) -> list[list[str]]:
    """The next rows: at most so many, and no more once their cells are long enough together."""
    part, chars = [], 0
    for row in islice(reader, ROWS_PER_BATCH):
        part.append(row)
        chars += sum(map(len, row))
        if chars >= CHARS_PER_BATCH:
            break
    return part


def _one_line(cells: list[str]) -> str:
    line = io.StringIO()
    csv.writer(line).writerow(cells)
    return line.getvalue().removesuffix("\r\n")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Contacts of all zipped exports at `path`."""
    return unpack_archives(spark.read.format("binaryFile").load(path))
