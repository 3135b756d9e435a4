"""Requests to a model: chunk payloads, one document per contact, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rolecast import schema as S
from rolecast.functions import text as X
from rolecast.operators.lookups import lookup_join
from rolecast.operators.numbering import BLOCK, running_sums
from rolecast.session import saved

SESSION_PART = 1_000
#: Of the rolling hash: a prime each, under 2**31 so that products stay in 63 bits, and a base.
DIGEST_FIELDS = ((2147483647, 1000003), (2147483629, 69069))
#: A history has fewer characters than two to this power.
HISTORY_BITS = 48


def render_chunks(chunked: DataFrame, keep: tuple[str, ...] = (), tasks: int | None = None) -> DataFrame:
    """One row per chunk: `id,title` lines in row order, and how many there are.

    With `tasks`, chunks are dealt by `chunk_id` to so many tasks before they are put together,
    so `ask_chunks` with as many calls takes them as they lie, without a second shuffle.
    """
    line = F.concat(F.coalesce(F.col("prospect_id"), F.lit("")), F.lit(","), X.sanitize_title(F.col("job_title")))
    rows = chunked.select(*keep, "chunk_id", F.struct("row_no", line.alias("line")).alias("entry"))
    dealt = rows.repartition(tasks, "chunk_id") if tasks else rows
    return dealt.groupBy(*keep, "chunk_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["line"]), "\n").alias("payload"),
        F.count(F.lit(1)).alias("n"),
    )


def with_pacing(chunks: DataFrame, calls_in_parallel: int = 1) -> DataFrame:
    return chunks.withColumns(
        {
            "est_tokens": X.estimated_tokens(F.col("n")),
            "pause_seconds": X.pause_seconds(F.col("n"), calls_in_parallel),
        }
    )


def system_message(frame: str, personas: str) -> str:
    return frame + personas


def message_list(system: Column, user: Column) -> Column:
    """Messages of one call; a role without text is left out."""
    both = F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )
    return F.filter(both, lambda m: m["content"].isNotNull() & (m["content"] != ""))


def request_documents(
    contacts: DataFrame, system: str, model: str = S.REQUEST_MODEL, temperature: float = 0.0
) -> DataFrame:
    """One JSON request per contact, keyed by its id."""
    user = F.concat(
        F.lit(S.REQUEST_ID_LABEL),
        F.coalesce(F.col("prospect_id"), F.lit("")),
        F.lit(S.REQUEST_TITLE_LABEL),
        X.sanitize_title(F.col("job_title")),
        F.lit(S.REQUEST_CLOSING),
    )
    body = F.struct(
        F.lit(model).alias("model"),
        message_list(F.lit(system.strip() + S.REQUEST_FORMAT), user).alias("messages"),
        F.lit(float(temperature)).alias("temperature"),
    )
    request = F.struct(
        F.coalesce(F.col("prospect_id"), F.lit("")).alias("custom_id"),
        F.lit(S.REQUEST_METHOD).alias("method"),
        F.lit(S.REQUEST_URL).alias("url"),
        body.alias("body"),
    )
    return contacts.select("prospect_id", F.to_json(request).alias("request"))


def seed_sessions(turns: DataFrame, system: str) -> DataFrame:
    """Put one system message, as turn -1, before the turns of every conversation."""
    seeds = turns.select("conv_id").distinct().select(
        "conv_id",
        F.lit(-1).cast("long").alias("turn"),
        F.lit("system").alias("role"),
        F.lit(system).alias("text"),
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(seeds)


def history_sizes(turns: DataFrame, width: int = BLOCK) -> DataFrame:
    """What each call resends: messages, characters and estimated tokens up to its turn.

    The text of a call's history is every row of its conversation up to that turn, so only
    its size is stored per turn; `call_histories` renders the text of the calls to be made.
    """
    # Texts are measured before the shuffle and do not travel through it.
    sized = turns.select(
        "conv_id",
        "turn",
        F.length("text").cast("long").alias("chars"),
        X.estimated_tokens(F.size(F.split("text", "\n"))).cast("long").alias("tokens"),
    )
    totals = {"n_messages": F.lit(1).cast("long"), "n_chars": F.col("chars"), "est_tokens": F.col("tokens")}
    return running_sums(sized, totals, "turn", ("conv_id",), width).drop("chars", "tokens")


def _power(base: int, prime: int, exponent: Column) -> Column:
    """base ** exponent modulo prime, by the bits of the exponent."""
    factors = F.array(
        *[F.struct(F.lit(1 << bit).cast("long").alias("bit"), F.lit(pow(base, 1 << bit, prime)).cast("long").alias("factor")) for bit in range(HISTORY_BITS)]
    )

    def times(product: Column, step: Column) -> Column:
        return F.when(exponent.bitwiseAND(step["bit"]) != 0, product * step["factor"] % prime).otherwise(product)

    return F.aggregate(factors, F.lit(1).cast("long"), times)


def _text_hash(text: Column, base: int, prime: int) -> Column:
    """Sum of (code point + 1) * base ** place over the characters of a text, modulo prime."""
    return F.aggregate(F.split(F.reverse(text), ""), F.lit(0).cast("long"), lambda found, c: (found * base + F.ascii(c) + 1) % prime)


def history_digests(turns: DataFrame, width: int = BLOCK) -> DataFrame:
    """`conv_id`, `turn`, `n_messages`, `n_chars`, `digest`: what each call resends, with a
    digest of its whole text, the lines `role:text` up to its turn, each with a line break.

    The digest is a polynomial hash by place in the history, in two fields. A turn's own hash
    times the base to the power of the characters before it is its share of every history it
    is in, so running sums of shares are the hashes of all histories: each text is read once,
    and no history is ever put together. Two texts differ in their digests but for a chance
    of about their length in 2**62.
    """
    line = F.concat(F.coalesce("role", F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")), F.lit("\n"))
    hashes = {f"_hash_{i}": _text_hash(line, base, prime) for i, (prime, base) in enumerate(DIGEST_FIELDS)}
    chars = F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("_chars")
    sized = saved(turns.select("conv_id", "turn", chars, F.length(line).cast("long").alias("_size"), *[h.alias(n) for n, h in hashes.items()]), "turn-hashes")
    counted = {"n_messages": F.lit(1).cast("long"), "n_chars": F.col("_chars"), "_end": F.col("_size")}
    placed = saved(running_sums(sized, counted, "turn", ("conv_id",), width), "turn-places")
    before = F.col("_end") - F.col("_size")
    shares = {f"_share_{i}": F.col(f"_hash_{i}") * _power(base, prime, before) % prime for i, (prime, base) in enumerate(DIGEST_FIELDS)}
    summed = running_sums(placed, shares, "turn", ("conv_id",), width)
    parts = [F.lpad(F.lower(F.hex(F.col(f"_share_{i}") % prime)), 8, "0") for i, (prime, _) in enumerate(DIGEST_FIELDS)]
    return summed.select("conv_id", "turn", "n_messages", "n_chars", F.concat(*parts).alias("digest"))


def session_parts(turns: DataFrame, part_size: int = SESSION_PART) -> DataFrame:
    """Message lists of whole conversations in parts of at most `part_size` turns.

    A conversation of ordinary length is one part, the body of its next request. A longer
    one is several parts in order, so that no row and no task holds an unbounded list.
    """
    part = F.expr(f"(turn - pmod(turn, {int(part_size)}L)) div {int(part_size)}L")
    return (
        turns.select("conv_id", part.alias("part"), F.struct("turn", "role", F.col("text").alias("content")).alias("m"))
        .groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_list("m")).alias("m"))
        .select(
            "conv_id",
            "part",
            F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"),
        )
    )


def whole_sessions(parts: DataFrame) -> DataFrame:
    """`conv_id`, `n_parts`, `messages`: the parts of each conversation put together, the body
    of its next request. One request is one row, so it must fit a task, as it must fit a model."""
    ordered = F.array_sort(F.collect_list(F.struct("part", "messages")))
    whole = parts.groupBy("conv_id").agg(ordered.alias("parts"))
    return whole.select("conv_id", F.size("parts").alias("n_parts"), F.flatten(F.transform("parts", lambda p: p["messages"])).alias("messages"))


def open_calls(turns: DataFrame) -> DataFrame:
    """`conv_id`, `call_turn`: the last user message of each conversation."""
    return turns.filter(F.col("role") == "user").groupBy("conv_id").agg(F.max("turn").alias("call_turn"))


def call_histories(turns: DataFrame, calls: DataFrame, part_size: int = SESSION_PART, **limits: int) -> DataFrame:
    """The messages sent with each call: all turns of its conversation up to its own.

    `calls` has one open call per conversation. The list comes in parts, as in `session_parts`.
    """
    asked = lookup_join(turns, calls, "conv_id", ("turn",), "inner", **limits)
    return session_parts(asked.filter(F.col("turn") <= F.col("call_turn")), part_size)
