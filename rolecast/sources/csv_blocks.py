"""CSV files with line breaks inside quoted cells, read in many tasks.

Whether a line break ends a record depends on all quotes before it, so such files are usually
a task each. Here each block of a file tells, by a regular look at its lines, how it would
end if it began outside of a quoted cell, and how if it began inside of one. These two
answers per block are enough to know how every block really begins: the last block before it
that ends the same way whatever its start, and the number of blocks since that turn one into
the other. Then every task puts its lines together to records, and only the pieces of records
that go across the edge of a block are shuffled."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rolecast.operators.lookups import BROADCAST_BYTES, fits_broadcast, lookup_join
from rolecast.session import saved

#: Blocks that begin inside of a cell and are broadcast, a few bytes each.
BROADCAST_BLOCKS = 4_000_000

#: Records that a task holds before it hands them on.
FLUSH_BYTES = 64 << 20

#: Cells from the start of a cell on, and then a quoted one that the line does not close.
_OPENED = re.compile(rb'(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]++|"")*+\Z')
_QUOTED = re.compile(rb'(?:[^"]++|"")*+')
_REST_OF_CELL = re.compile(rb'"[^,]*+')

BLOCKS = "file long, block long, first string, if_outside boolean, if_inside boolean"
PIECES = "file long, block long, line long, kind string, record string"


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted cell is open at the end of a line that began inside of one or not."""
    if inside:
        at = _QUOTED.match(line).end()
        if at == len(line):
            return True
        at = _REST_OF_CELL.match(line, at).end()
        return at < len(line) and _OPENED.match(line, at + 1) is not None
    return b'"' in line and _OPENED.match(line) is not None


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, pa.Array, list[int], dict]]:
    """Runs of lines of one block: its key, whether the run begins it, its lines, which of them
    have a quote, other cells."""
    last = None
    for batch in batches:
        files, starts = batch.column("file").to_numpy(), batch.column("block").to_numpy()
        lines = batch.column("value")
        quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
        edges = 1 + np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1]))
        bounds = [0, *edges.tolist(), len(files)] if len(files) else []
        for at, end in zip(bounds, bounds[1:]):
            key = int(files[at]), int(starts[at])
            among = quoted[slice(*np.searchsorted(quoted, (at, end)))] - at
            yield key, key != last, lines[at:end], among.tolist(), {name: batch.column(name)[at].as_py() for name in batch.schema.names[3:]}
            last = key


def _bytes(lines: pa.Array, chosen: list[int] | None = None) -> list[bytes]:
    return (lines if chosen is None else lines.take(pa.array(chosen, pa.int64()))).cast(pa.binary()).to_pylist()


def look_at_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its first line, and how it ends for each way of beginning."""
    rows: list[list] = []
    for key, begins, lines, quoted, _ in _blocks(batches):
        if begins:
            rows.append([*key, _bytes(lines[:1])[0].decode(), False, True])
        outside, inside = rows[-1][3:]
        for line in _bytes(lines, quoted):  # at the others nothing changes
            if outside == inside:  # and stay alike
                outside = inside = ends_inside(line, inside)
            else:
                outside, inside = ends_inside(line, outside), ends_inside(line, inside)
        rows[-1][3:] = [outside, inside]
    names = [part.split()[0] for part in BLOCKS.split(", ")]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], names=names)


def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block: `whole` ones, `more` of one that began in an earlier block, and
    the `start` of one that goes on in the next. The number of the line keeps the order."""
    key, held, inside, number, first, kind = None, [], False, 0, 0, "whole"
    rows: list[tuple] = []
    chars = 0

    def flush() -> pa.RecordBatch:
        names = [part.split()[0] for part in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], names=names)

    def ended() -> None:
        if held:  # the block ends inside of a cell
            rows.append((*key, first, "start" if kind == "whole" else kind, b"\n".join(held).decode()))

    for now, begins, run, quoted, cells in _blocks(batches):
        if begins:
            ended()
            key, held, inside, number = now, [], bool(cells["inside"]), 0
            kind = "more" if inside else "whole"
        lines, done = _bytes(run), 0  # so many lines are in rows or held
        for at in [*quoted, len(lines)]:
            if not inside:  # lines without quotes, a record each
                rows.extend((*key, number + i, "whole", lines[i].decode()) for i in range(done, at))
                chars += sum(map(len, lines[done:at]))
                done = at
            if at < len(lines):
                inside = ends_inside(lines[at], inside)
                if not inside:
                    if not held:
                        first = number + done
                    record = b"\n".join([*held, *lines[done : at + 1]])
                    rows.append((*key, first, kind, record.decode()))
                    chars, held, kind, done = chars + len(record), [], "whole", at + 1
            if len(rows) >= 10_000 or chars >= FLUSH_BYTES:
                yield flush()
                rows, chars = [], 0
        if done < len(lines):
            if not held:
                first = number + done
            held.extend(lines[done:])
        number += len(lines)
    ended()
    if rows:
        yield flush()


def block_starts(blocks: DataFrame) -> DataFrame:
    """Adds `inside`: whether a block begins inside of a quoted cell. A file begins outside."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    same, turns = F.col("if_outside") == F.col("if_inside"), F.col("if_outside") & ~F.col("if_inside")
    counted = blocks.withColumn("turned", F.coalesce(F.sum(turns.cast("int")).over(before), F.lit(0)))
    after = F.col("turned") + turns.cast("int")
    fixed = counted.withColumn("sure", F.when(same, F.struct(F.col("if_outside").alias("inside"), after.alias("turned"))))
    last = fixed.withColumn("sure", F.last("sure", ignorenulls=True).over(before))
    was_inside, turned = F.coalesce("sure.inside", F.lit(False)), F.coalesce("sure.turned", F.lit(0))
    return last.withColumn("inside", was_inside != ((F.col("turned") - turned) % 2 == 1)).drop("sure", "turned")


def csv_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`value`, `file`, `block`, `place` of every line: which file, by a hash of its path,
    where in it the block starts, and a number that grows along a block. The numbers hold for
    this frame, whose files are split once. Lines end in a line feed, with or without a
    carriage return."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def csv_files(lines: DataFrame) -> DataFrame:
    """`file`, `header`, `first`, `broken` of each file: its first line and that line's place,
    and whether some quoted cell may hold a line break, as some line has an odd number of
    quotes."""
    odd = F.size(F.split("value", '"')) % 2 == 0
    first = F.min_by(F.struct("value", "place"), F.struct("block", "place")).alias("first")
    # A set, unlike a flag, lets Spark keep the files of a task in a hash table: no line is sorted.
    broken = F.array_contains(F.collect_set("odd"), True).alias("broken")
    files = lines.withColumn("odd", odd).groupBy("file").agg(first, broken)
    return files.select("file", F.col("first.value").alias("header"), F.col("first.place").alias("first"), "broken")


def block_records(lines: DataFrame) -> DataFrame:
    """`file`, `block`, `line`, `record` of all records of lines, headers included; the three
    numbers tell files apart and order the records of a file.

    The lines are read twice, the records lie in saved tables. A quote that is never closed takes the rest of its file into
    one cell, as it does in any reader of such files."""
    looked = lines.select("value", "file", "block").mapInArrow(look_at_blocks, BLOCKS)
    blocks = saved(block_starts(saved(looked, "blocks")), "block-starts")
    inside = blocks.filter("inside").select("file", "block", "inside")
    if fits_broadcast(inside, BROADCAST_BLOCKS, BROADCAST_BYTES):
        known = lines.join(F.broadcast(inside), ["file", "block"], "left")
    else:  # the lines of a block stay together and in order
        met = lines.join(inside, ["file", "block"], "left").repartition("file", "block")
        known = met.sortWithinPartitions("file", "block", "place")
    pieces = saved(known.select("value", "file", "block", "inside").mapInArrow(put_together, PIECES), "pieces")
    return pieces.filter("kind = 'whole'").drop("kind").unionByName(saved(_across(pieces.filter("kind <> 'whole'")), "across"))


def _across(pieces: DataFrame) -> DataFrame:
    """Records that lie in several blocks; their order is that of their start."""
    upto = Window.partitionBy("file").orderBy("block", "line").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("number", F.count_if(F.col("kind") == "start").over(upto))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "record")))
    whole = numbered.groupBy("file", "number").agg(parts.alias("parts"))
    first = F.get("parts", F.lit(0))
    text = F.array_join(F.transform("parts", lambda part: part["record"]), "\n")
    return whole.select("file", first["block"].alias("block"), first["line"].alias("line"), text.alias("record"))


def header_names(header: str) -> list[str]:
    """Names of a header line; one that is empty or was there before is told by its place."""
    cells = next(csv.reader([header.rstrip("\r\n").removeprefix("\ufeff")], strict=False), [])
    found: list[str] = []
    for i, name in enumerate(cells):
        taken = {other.lower() for other in found}
        found.append(f"_c{i}" if not name else f"{name}{i}" if name.lower() in taken else name)
    return found


def read_csv_by_name(spark: SparkSession, path: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """CSV files with headers as one table of text columns, found by name; a column that a
    file lacks is null in its rows, blank lines are left out.

    Files without line breaks in cells are parsed line by line where they are read, others
    are put together from blocks; a first look at all lines tells which is which, `multi_line`
    decides it for all. The driver sees the different headers, not the files: which file has
    which is a table, broadcast if it is measured to be small."""
    lines = csv_lines(spark, path)
    files = saved(csv_files(lines), "csv-files")
    if multi_line is not None:
        files = files.withColumn("broken", F.lit(multi_line))
    kinds = {row["broken"] for row in files.select("broken").distinct().collect()}
    headers, records = [], []
    if False in kinds:
        plain = files.filter(~F.col("broken"))
        headers.append(plain.select("file", "header"))
        rows = _among(lines, plain.select("file", "first")).filter(F.col("place") != F.col("first"))
        records.append(rows.select("file", F.col("value").alias("record")))
    if True in kinds:
        broken = files.filter("broken").select("file")
        found = block_records(lines if False not in kinds else _among(lines, broken))
        is_first = (F.col("block") == 0) & (F.col("line") == 0)
        headers.append(found.filter(is_first).select("file", F.col("record").alias("header")))
        records.append(found.filter(~is_first).select("file", "record"))
    if not headers:
        return spark.read.csv(path, header=True, inferSchema=False, escape='"', encoding="UTF-8")
    return _cells_by_name(reduce(DataFrame.unionByName, records), saved(reduce(DataFrame.unionByName, headers), "headers"))


def _among(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Lines of some files, with what is known of these. A few bytes per file are broadcast if
    that is measured to be small; otherwise lines are shuffled with their place."""
    if fits_broadcast(files, BROADCAST_BLOCKS, BROADCAST_BYTES):
        return lines.join(F.broadcast(files), "file")
    return lines.join(files, "file").repartition("file", "block").sortWithinPartitions("file", "block", "place")


def _cells_by_name(records: DataFrame, headers: DataFrame) -> DataFrame:
    shapes = {row["header"]: header_names(row["header"]) for row in headers.select("header").distinct().collect()}
    columns: dict[str, str] = {}  # by small letters, as Spark tells columns apart
    for _, names in sorted(shapes.items()):
        for name in names:
            columns.setdefault(name.lower(), name)
    if not columns:
        return records.select().limit(0)
    width = max(map(len, shapes.values()))
    spots = F.create_map(*[part for text, names in sorted(shapes.items()) for part in (F.lit(text), _spots(names, list(columns)))])
    told = saved(headers.select("file", spots[F.col("header")].alias("spots")), "header-spots")
    rows = records.filter(F.col("record").rlike(r"[^\x00-\x20]"))
    fields = ", ".join(f"c{i} string" for i in range(width))
    # Only a record with a carriage return near its end is looked through for one at its end.
    end = F.substring(F.col("record").cast("binary"), -4, 4).cast("string")
    record = F.when(end.contains("\r"), F.regexp_replace("record", "\r$", "")).otherwise(F.col("record"))
    parsed = F.from_csv(record, fields, {"escape": '"', "multiLine": "true"})
    met = lookup_join(rows, told, "file", ["record"], "inner").withColumn("parsed", parsed)
    listed = met.withColumn("cells", F.array(*[F.col(f"parsed.c{i}") for i in range(width)]))
    return listed.select(*[F.get("cells", F.get("spots", F.lit(i))).alias(name) for i, name in enumerate(columns.values())])


def _spots(names: list[str], columns: list[str]) -> Column:
    """For each column, its place in a header, null if the header lacks it."""
    small = [name.lower() for name in names]
    return F.array(*[F.lit(small.index(name) if name in small else None).cast("int") for name in columns])
