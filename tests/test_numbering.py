import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import rows
from rolecast.operators.classify import rule_replies
from rolecast.operators.numbering import assign_chunks, number_rows, running_sums
from rolecast.operators.replies import parse_reply_lines
from rolecast.operators.requests import (
    DIGEST_FIELDS,
    call_histories,
    history_digests,
    history_sizes,
    open_calls,
    render_chunks,
    seed_sessions,
    session_parts,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(-(2**62), 2**62), min_size=1, max_size=60))
def test_positions_of_any_whole_numbers(spark, order):
    df = spark.createDataFrame([(v,) for v in order], "seq long")
    got = {r.seq: r.row_no for r in number_rows(df).collect()}
    assert got == {v: i for i, v in enumerate(sorted(order), 1)}


def test_positions_after_a_scan(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("seq"))
    assert rows(number_rows(df).select(F.max("row_no"), F.count("*"))) == [(1000, 1000)]


def test_running_sum_with_a_hot_key(spark):
    df = spark.range(500).select(F.when(F.col("id") < 450, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    got = running_sums(df, {"total": F.col("o")}, "o", ["k"], width=8)
    hot = [r.total for r in got.filter("k = 1").orderBy("o").collect()]
    assert hot == [sum(range(i + 1)) for i in range(450)]
    assert got.count() == 500


def test_chunks_and_payloads(spark):
    df = spark.range(23).select(
        F.col("id").alias("seq"), F.col("id").cast("string").alias("prospect_id"), F.lit("VP, Sales").alias("job_title")
    )
    chunks = render_chunks(assign_chunks(df, 10)).orderBy("chunk_id").collect()
    assert [c.n for c in chunks] == [10, 10, 3]
    assert chunks[2].payload == "20,VP  Sales\n21,VP  Sales\n22,VP  Sales"


def test_chunk_round_trip(spark):
    df = spark.range(57).select(
        F.col("id").alias("seq"), F.col("id").cast("string").alias("prospect_id"), F.lit("Data Analyst, EU").alias("job_title")
    )
    payloads = render_chunks(assign_chunks(df, 10))
    ask = rule_replies()
    replies = spark.createDataFrame([(c.chunk_id, ask("", c.payload)) for c in payloads.collect()], "chunk_id long, reply string")
    back = parse_reply_lines(replies)
    assert rows(back, "prospect_id", "persona") == rows(df.select("prospect_id", F.lit("Data User")))


def test_sparse_keys_do_not_meet_in_one_task(spark):
    df = spark.range(20_000).select(F.xxhash64("id").alias("seq"))
    got = number_rows(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Window [") :]  # what the only window without partition reads
    assert "HashAggregate(keys=[_numbering_range" in before and plan.count("Window [") == 1
    assert rows(got.select(F.min("row_no"), F.max("row_no"), F.countDistinct("row_no"))) == [(1, 20_000, 20_000)]


def test_sessions(spark):
    turns = spark.createDataFrame(
        [(1, t, "user", f"m{t}") for t in range(25)] + [(2, 0, "user", "a\nb")],
        "conv_id long, turn long, role string, text string",
    )
    seeded = seed_sessions(turns, "sys")
    sizes = history_sizes(seeded, width=4)
    last = sizes.filter("conv_id = 1 and turn = 24").first()
    assert (last.n_messages, last.est_tokens) == (26, 26 * 120)
    assert sizes.filter("conv_id = 2 and turn = 0").first().est_tokens == 3 * 120
    parts = session_parts(seeded, 10).filter("conv_id = 1").orderBy("part").collect()
    assert [p.part for p in parts] == [-1, 0, 1, 2]
    texts = [m.content for p in parts for m in p.messages]
    assert texts == ["sys"] + [f"m{t}" for t in range(25)]


def test_call_histories(spark):
    turns = spark.createDataFrame(
        [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(12)] + [(2, 0, "assistant", "x"), (3, 0, "user", "y")],
        "conv_id long, turn long, role string, text string",
    )
    calls = open_calls(turns)
    assert rows(calls) == [(1, 10), (3, 0)]
    for limits in ({}, {"max_rows": 0, "hot_rows": 2}):
        parts = call_histories(turns, calls, 4, **limits)
        sent = [m.content for p in parts.filter("conv_id = 1").orderBy("part").collect() for m in p.messages]
        assert sent == [f"m{t}" for t in range(11)]
        assert parts.filter("conv_id = 2").count() == 0


def plain_digest(history):
    return "".join(f"{sum((ord(c) + 1) * pow(base, i, prime) for i, c in enumerate(history)) % prime:08x}" for prime, base in DIGEST_FIELDS)


def test_history_digests(spark):
    draw = random.Random(4)
    turns = [(conv, t, draw.choice(["user", "assistant", None]), draw.choice([None, "", "".join(draw.choices("ab é😀\n\0,", k=draw.randint(0, 40)))])) for conv in range(6) for t in range(draw.randint(1, 30))]
    turns += [(9, t, "user", "same") for t in range(40)] + [(10, 5, "user", "x" * 70_000), (10, 900, "assistant", "later")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3)
    want, histories = {}, set()
    for conv, turn, _, _ in turns:
        upto = sorted(row[1:] for row in turns if row[0] == conv and row[1] <= turn)
        history = "".join(f"{role or ''}:{text or ''}\n" for _, role, text in upto)
        histories.add(history)
        want[conv, turn] = (len(upto), sum(len(text or "") for _, _, text in upto), plain_digest(history))
    got = {(r.conv_id, r.turn): (r.n_messages, r.n_chars, r.digest) for r in history_digests(df, width=7).collect()}
    assert got == want and len({digest for _, _, digest in got.values()}) == len(histories)
