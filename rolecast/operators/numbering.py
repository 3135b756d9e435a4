"""Exact row positions, running sums and chunks without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolecast.session import saved

BLOCK = 1 << 16


def _block(order_by: str, width: int) -> Column:
    return F.expr(f"`{order_by}` div {width}L")


def _sums_before(totals: DataFrame, names: Sequence[str], within: Sequence[str], width: int) -> DataFrame:
    """For each block, the sums over the smaller blocks of the same `within`.

    Blocks are summed in groups of `width`, so a window holds `width` blocks, and the last
    one a row per group.
    """
    grouped = totals.withColumn("_group", _block("_block", width))
    earlier = Window.partitionBy(*within, "_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = grouped.select(
        *within, "_block", "_group", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names]
    )
    groups = grouped.groupBy(*within, "_group").agg(*[F.sum(n).alias(n) for n in names])
    earlier_groups = Window.partitionBy(*within).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    outside = groups.select(
        *within, "_group", *[F.coalesce(F.sum(n).over(earlier_groups), F.lit(0)).alias(f"_o_{n}") for n in names]
    )
    return inside.join(outside, [*within, "_group"]).select(
        *within, "_block", *[(F.col(n) + F.col(f"_o_{n}")).alias(f"_before_{n}") for n in names]
    )


def running_sums(
    df: DataFrame,
    values: Mapping[str, Column],
    order_by: str,
    within: Sequence[str] = (),
    width: int = BLOCK,
) -> DataFrame:
    """Add a column per entry of `values`: its sum up to and including each row.

    `order_by` is a unique whole number per `within`, such as a turn or a row number; for
    values with wide gaps, number the rows first. Rows are cut into blocks of `width`
    consecutive order values: no task sorts more than one block, however large a key is.
    `df` is read twice, so hand in a saved table, not the end of a long plan. The sums per
    block are saved at once, so that their three uses do not read `df` again.
    """
    within, names = list(within), list(values)
    blocked = df.withColumns(dict(values)).withColumn("_block", _block(order_by, width))
    totals = saved(blocked.groupBy(*within, "_block").agg(*[F.sum(n).alias(n) for n in names]), "block-sums")
    offsets = _sums_before(totals, names, within, width)
    upto = Window.partitionBy(*within, "_block").orderBy(order_by).rowsBetween(Window.unboundedPreceding, 0)
    summed = blocked.withColumns({n: F.sum(n).over(upto) for n in names})
    return summed.join(offsets, [*within, "_block"]).select(
        *df.columns, *[(F.col(n) + F.col(f"_before_{n}")).alias(n) for n in names]
    )


def number_rows(df: DataFrame, order_by: str | Sequence[str] = "seq", name: str = "row_no") -> DataFrame:
    """Add the position of each row, from 1, in the order of `order_by`, whose values
    together are unique; they may be of any sortable type and as sparse as they like.

    Rows are dealt to ranges of the order, sorted there and saved, so a range is read as it
    was numbered. Only the row counts of the ranges meet in one task and are broadcast: one
    row per shuffle partition.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = saved(ranged.withColumn("_numbering_place", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_numbering_range", F.shiftright("_numbering_place", 33))  # the partition, as that function has it
    earlier = Window.orderBy("_numbering_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_numbering_range").agg(F.count("*").alias("_numbering_n"))
    offsets = counts.select("_numbering_range", F.coalesce(F.sum("_numbering_n").over(earlier), F.lit(0)).alias("_numbering_before"))
    position = F.col("_numbering_before") + F.col("_numbering_place").bitwiseAND((1 << 33) - 1) + 1
    return placed.join(F.broadcast(offsets), "_numbering_range").select(*df.columns, position.alias(name))


def assign_chunks(
    df: DataFrame, size: int, order_by: str | Sequence[str] = "seq", name: str = "chunk_id"
) -> DataFrame:
    """Cut the rows into consecutive chunks of `size`, numbered from 0; keeps `row_no`."""
    return number_rows(df, order_by).withColumn(name, F.expr(f"(row_no - 1) div {int(size)}L"))


def attach_seq(df: DataFrame) -> DataFrame:
    """Add `seq`, the order in which a scan delivers its rows.

    Use right after a scan, then write the frame: the numbers hold for one reading of the
    files, not for a plan that may be split differently the next time.
    """
    return df.withColumn("seq", F.monotonically_increasing_id())
