"""Reproducible shuffle into shards (operator 1): a Feistel permutation of row numbers.

Rows are numbered 0 .. n - 1 in key order. The permutation works on pairs of digits in base
`side`, the least number with side * side >= n, and walks on along its cycle while it is
outside 0 .. n - 1. The permuted number p gives shard p % shards and slot p // shards, so
shard sizes differ by one at most, slots have no gaps, and both can be computed for one row
without the others."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecast.llm.texts import unused
from rolecast.operators.numbering import number_rows

ROUNDS = 6
#: A prime below 2**31, so that products of two residues fit a long.
PRIME = 2**31 - 1
FACTORS = (48271, 69621)


def round_keys(seed: int) -> list[int]:
    return [random.Random(f"{seed}-{i}").randrange(PRIME) for i in range(ROUNDS)]


def _permuted(number: Column, side: int, seed: int) -> Column:
    """One pass of the Feistel network over 0 .. side * side - 1."""

    def step(state: Column, key: Column) -> Column:
        first = (state["right"] * FACTORS[0] + key) % PRIME
        second = ((first * first + key) % PRIME * FACTORS[1] + first) % PRIME
        return F.struct(state["right"].alias("left"), ((state["left"] + second) % side).alias("right"))

    start = F.struct(F.call_function("div", number, F.lit(side)).alias("left"), (number % side).alias("right"))
    keys = F.array(*[F.lit(key).cast("long") for key in round_keys(seed)])
    return F.aggregate(keys, start, step, lambda state: state["left"] * side + state["right"])


def permuted(number: Column, n: int, seed: int = 0) -> Column:
    """Place of row `number` of n in the shuffle; both are 0 .. n - 1.

    Fewer than 2 * side places lie outside; they are met by one row in side / 2, and only
    those rows walk, so the walks cost no more than a constant for each row."""
    side = max(1, math.isqrt(max(n, 1) - 1) + 1)
    outside = side * side - n
    once = _permuted(number, side, seed)
    if outside <= 0:
        return once
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(outside)),
        once,
        lambda place, _: F.when(place < n, place).otherwise(_permuted(place, side, seed)),
    )
    return F.when(once < n, once).otherwise(walk)


def shuffle_into_shards(rows: DataFrame, shards: int, order_by: list[str], seed: int = 0) -> DataFrame:
    """`rows` with shard (int) and slot (long).

    Rows are numbered in the order of `order_by`, nulls first; rows equal there are numbered
    in the order in which the scan finds them, which changes nothing if they are repeated
    rows. An empty table stays empty. Columns named shard or slot are replaced. All columns
    of `rows` are written once, so select the ones needed; only they are shuffled, once."""
    kept = [name for name in rows.columns if name not in ("shard", "slot")]
    tie, row, place = (unused(kept, name) for name in ("_tie", "_row", "_shuffled"))
    tied = rows.select(*kept, F.monotonically_increasing_id().alias(tie))
    numbered = number_rows(tied, [*order_by, tie], row)
    placed = numbered.withColumn(place, permuted(F.col(row) - 1, numbered.count(), seed))
    return placed.select(
        *kept,
        (F.col(place) % shards).cast("int").alias("shard"),
        F.expr(f"`{place}` div {int(shards)}").alias("slot"),
    )


def document_shards(docs: DataFrame, shards: int, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key`, size (UTF-8 bytes of the text, none if null, plus
    16), text_crc32 (of the text; null as empty), law, shard, slot, grown_shard (null, as the
    law is not `key`). Null keys and repeated rows are rows like others."""
    data = F.coalesce(docs[text], F.lit("")).cast("binary")
    rows = docs.select(docs[key].alias(key), (F.octet_length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    placed = shuffle_into_shards(rows, shards, [key, "text_crc32", "size"], seed)
    return placed.select(
        key, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def shards_sql(shards: int, seed: int = 0) -> str:
    """The same rows of `documents` in DuckDB SQL."""
    state = "{'l': place // side, 'r': place % side}"
    for key in round_keys(seed):
        first = f"((s.r * {FACTORS[0]} + {key}) % {PRIME})"
        state = (
            f"list_transform([{state}], lambda s: {{'l': s.r, 'r': (s.l + ((({first} * {first} + {key}) % {PRIME}) "
            f"* {FACTORS[1]} + {first}) % {PRIME}) % side}})[1]"
        )
    pass_ = f"list_transform([{state}], lambda s: s.l * side + s.r)[1]"
    return f"""
with recursive crc_table as (
    select list(c order by i) as t from (
        select i, list_reduce([i::ubigint] || list_transform(range(8), lambda x: 0::ubigint),
            lambda c, x: if(c & 1 = 1, xor(c >> 1, 3988292384::ubigint), c >> 1)) as c from range(256) r(i))
),
bytes as (
    select doc_id, row_number() over () as tie, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::ubigint) as b from documents
),
digests as (
    select doc_id, tie, len(b)::bigint + 16 as size,
        xor(list_reduce([4294967295::ubigint] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::bigint + 1])), 4294967295::ubigint)::bigint as text_crc32
    from bytes, crc_table
),
numbered as (
    select *, row_number() over (order by doc_id nulls first, text_crc32, size, tie) - 1 as row, count(*) over () as n from digests
),
sized as (select *, ceil(sqrt(n))::bigint as side from numbered),
walk as (
    select tie, n, side, {pass_.replace("place", "row")} as place from sized
    union all
    select tie, n, side, {pass_} as place from walk where place >= n
),
ended as (select tie, place from walk where place < n)
select doc_id, size, text_crc32, 'rows' as law, (place % {shards})::int as shard, place // {shards} as slot, null::int as grown_shard
from digests join ended using (tie)
"""
