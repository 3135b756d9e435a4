"""Queries on chunks, requests, retries and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.fixtures import VALID, base, fixture
from catalogue.registry import query, sql_list
from rolecast import schema as S
from rolecast.functions import text as X
from rolecast.operators import classify, requests
from rolecast.operators.numbering import assign_chunks
from rolecast.session import saved

SYSTEM = "You sort job titles.\nPersonas: see below. "
CHUNKED_SQL = "select *, row_number() over (order by seq) as row_no, (row_number() over (order by seq) - 1) // 250 as chunk_id from prospects"


@query(f"select prospect_id, seq, row_no, chunk_id from ({CHUNKED_SQL})")
def req_chunk_assign(spark, sf):
    chunked = assign_chunks(fixture(spark, sf, "prospects"), S.MAX_CHUNK)
    return chunked.select("prospect_id", "seq", "row_no", "chunk_id")


@query(
    f"""select chunk_id, string_agg(prospect_id || ',' || replace(job_title, ',', ' '), chr(10) order by row_no) as payload,
    count(*) as n from ({CHUNKED_SQL}) group by chunk_id"""
)
def req_chunk_payload(spark, sf):
    return requests.render_chunks(assign_chunks(fixture(spark, sf, "prospects"), S.MAX_CHUNK))


@query(
    f"""select chunk_id, count(*) as n, count(*) * 120 as est_tokens,
    round(greatest(1.5::double, count(*)::double * 120::double / 360000::double * 60::double) * 4::double, 9) as pause_seconds
    from ({CHUNKED_SQL}) group by chunk_id"""
)
def req_pacing(spark, sf):
    chunked = assign_chunks(fixture(spark, sf, "prospects"), S.MAX_CHUNK)
    sizes = chunked.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"))
    paced = requests.with_pacing(sizes, calls_in_parallel=4)
    return paced.withColumn("pause_seconds", F.round("pause_seconds", 9))


@query(
    """select prospect_id as custom_id, 'POST' as method, '/v1/chat/completions' as url, 'gpt-4.1-nano' as model,
    0.0::double as temperature, 'system,user' as roles,
    'You sort job titles.' || chr(10) || 'Personas: see below.' || chr(10) || chr(10)
      || 'CRITICAL OUTPUT FORMAT: Respond with a SINGLE JSON object only.' || chr(10)
      || 'Required keys: {"persona": <one of the defined personas>, "certainty": <0-100 integer or %>}.' || chr(10)
      || 'Do not include extra keys, code fences, or commentary.' as system_text,
    'Prospect Id: ' || prospect_id || chr(10) || 'Job Title: ' || replace(job_title, ',', ' ') || chr(10) || chr(10)
      || 'Return ONLY the JSON.' as user_text
    from prospects"""
)
def req_jsonl_fields(spark, sf):
    documents = requests.request_documents(fixture(spark, sf, "prospects"), SYSTEM)
    form = """custom_id STRING, method STRING, url STRING,
        body STRUCT<model: STRING, messages: ARRAY<STRUCT<role: STRING, content: STRING>>, temperature: DOUBLE>"""
    read = documents.select(F.from_json("request", form).alias("r"))
    return read.select(
        "r.custom_id",
        "r.method",
        "r.url",
        "r.body.model",
        "r.body.temperature",
        F.array_join("r.body.messages.role", ",").alias("roles"),
        F.get("r.body.messages", F.lit(0))["content"].alias("system_text"),
        F.get("r.body.messages", F.lit(1))["content"].alias("user_text"),
    )


@query(
    """select event_id, attempt, chunk_size,
    greatest(coalesce(try_cast(nullif(regexp_extract(error, 'try again in ([0-9]+(?:\\.[0-9]+)?)s', 1), '') as double), 0),
             least(30.0::double, 2.0::double * pow(2.0::double, attempt))) as wait_seconds,
    case when contains(lower(error), 'rate limit') or contains(error, '429')
         then least(chunk_size, greatest(10, chunk_size // 2)) else chunk_size end as next_chunk
    from attempts"""
)
def rty_plan(spark, sf):
    return fixture(spark, sf, "attempts").select(
        "event_id",
        "attempt",
        "chunk_size",
        X.backoff_seconds(F.col("attempt"), F.col("error")).alias("wait_seconds"),
        X.chunk_after_error(F.col("error"), F.col("chunk_size")).alias("next_chunk"),
    )


@query(
    """select event_id, error,
    coalesce(try_cast(nullif(regexp_extract(error, 'try again in ([0-9]+(?:\\.[0-9]+)?)s', 1), '') as double), 0) as hint
    from attempts"""
)
def rty_hint(spark, sf):
    return fixture(spark, sf, "attempts").select(
        "event_id", "error", X.retry_hint_seconds(F.col("error")).alias("hint")
    )


@query(
    f"""with remaining as (select distinct prospect_id from prospects),
    ok as (select prospect_id from replies where persona in ({sql_list(VALID)})),
    failed as (select cast(o_orderkey as string) as prospect_id from orders where o_orderstatus = 'F')
    (select prospect_id from remaining except select prospect_id from ok) union select prospect_id from failed"""
)
def pass_remaining(spark, sf):
    ok = fixture(spark, sf, "replies").filter(F.col("persona").isin(*S.PERSONAS))
    failed = (
        base(spark, sf, "orders")
        .filter("o_orderstatus = 'F'")
        .select(F.col("o_orderkey").cast("string").alias("prospect_id"))
    )
    return classify.remaining_ids(fixture(spark, sf, "prospects"), ok, failed)


_UPTO = "over (partition by conv_id order by turn rows between unbounded preceding and current row)"


def _hash_sql(prime: int, base: int) -> str:
    codes = "list_transform(string_split(reverse(history), ''), lambda c: cast(ascii(c) + 1 as bigint))"
    return f"printf('%08x', list_reduce({codes}, lambda a, b: (a * {base} + b) % {prime}, 0::bigint))"


@query(
    f"""select conv_id, turn, n_messages, n_chars, {" || ".join(_hash_sql(*field) for field in requests.DIGEST_FIELDS)} as digest
    from (select conv_id, turn, count(*) {_UPTO} as n_messages, cast(sum(length(text)) {_UPTO} as bigint) as n_chars,
                 string_agg(role || ':' || text || chr(10), '') {_UPTO} as history
          from conversations)"""
)
def conv_history(spark, sf):
    """The whole history of every turn, by its size and a digest of its text."""
    return requests.history_digests(base(spark, sf, "conversations"), width=64)


@query(
    f"""select conv_id, turn, cast(sum(120 * len(string_split(text, chr(10)))) {_UPTO} as bigint) as est_tokens
    from conversations"""
)
def conv_tokens(spark, sf):
    return requests.history_sizes(base(spark, sf, "conversations"), width=64).select("conv_id", "turn", "est_tokens")


@query(
    """select conv_id, turn, role, text from conversations
    union all select distinct conv_id, -1, 'system', 'You sort job titles.' from conversations"""
)
def conv_seed(spark, sf):
    return requests.seed_sessions(base(spark, sf, "conversations"), "You sort job titles.")


@query(
    """select conv_id, turn // 1000 as part, count(*) as n_messages,
    md5(string_agg(role || ':' || text, chr(10) order by turn)) as digest
    from conversations group by conv_id, turn // 1000"""
)
def conv_session(spark, sf):
    """The whole message list of each conversation, checked by a digest of its text."""
    return _digest(requests.session_parts(base(spark, sf, "conversations")))


def _digest(parts):
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return parts.select(
        "conv_id",
        "part",
        F.size("messages").cast("long").alias("n_messages"),
        F.md5(F.array_join(lines, "\n")).alias("digest"),
    )


@query(
    """with calls as (select conv_id, max(turn) as call_turn from conversations where role = 'user' group by 1)
    select c.conv_id, turn // 1000 as part, count(*) as n_messages,
    md5(string_agg(role || ':' || text, chr(10) order by turn)) as digest
    from conversations c join calls on c.conv_id = calls.conv_id and turn <= call_turn group by 1, 2"""
)
def conv_request(spark, sf):
    """What is sent with the last user message of each conversation."""
    turns = base(spark, sf, "conversations")
    return _digest(requests.call_histories(turns, saved(requests.open_calls(turns), "calls")))


@query(
    """select conv_id, turn, case when role in ('system', 'user') and text <> '' then 1 else 0 end as n_messages,
    case when role in ('system', 'user') and text <> '' then role else '' end as roles,
    case when role in ('system', 'user') then text else '' end as contents
    from conversations"""
)
def msg_assembly(spark, sf):
    turns = base(spark, sf, "conversations")
    system = F.when(F.col("role") == "system", F.col("text"))
    user = F.when(F.col("role") == "user", F.col("text")).otherwise("")
    assembled = turns.withColumn("m", requests.message_list(system, user))
    return assembled.select(
        "conv_id",
        "turn",
        F.size("m").alias("n_messages"),
        F.array_join("m.role", ",").alias("roles"),
        F.array_join("m.content", "").alias("contents"),
    )


SPARSE = "(o_orderkey % 1000003) * 4398042316799 + o_orderkey"


@query(
    f"""select o_orderkey, row_number() over (order by {SPARSE}) as row_no,
    (row_number() over (order by {SPARSE}) - 1) // 250 as chunk_id from orders"""
)
def req_chunk_sparse(spark, sf):
    """Chunks in the order of keys with huge gaps."""
    rows = base(spark, sf, "orders").select("o_orderkey", F.expr(SPARSE).alias("seq"))
    return assign_chunks(rows, S.MAX_CHUNK).select("o_orderkey", "row_no", "chunk_id")


@query(
    """select conv_id, cast(ceil((count(*) filter (turn >= 0)) / 3.0) + 1 as int) as n_parts,
    string_agg(role || ':' || text, chr(10) order by turn) as whole from (
        select conv_id, turn, role, text from conversations
        union all select distinct conv_id, -1, 'system', 'sys' from conversations) group by conv_id"""
)
def conv_parts(spark, sf):
    """Sessions in parts of three turns, put together to one request each."""
    seeded = requests.seed_sessions(base(spark, sf, "conversations"), "sys")
    whole = requests.whole_sessions(requests.session_parts(seeded, 3))
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return whole.select("conv_id", "n_parts", F.array_join(lines, "\n").alias("whole"))
