"""The online run: chunks of contacts to a classifier, in up to three passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecast import schema as S
from rolecast.functions import text as X
from rolecast.operators.classify import REPLY_SCHEMA, ReplyFunction, ask_chunks
from rolecast.operators.clean import keep_valid_persona
from rolecast.operators.decide import decide
from rolecast.operators.numbering import attach_seq, number_rows
from rolecast.operators.replies import keep_nonempty, parse_reply_lines, tidy_replies
from rolecast.operators.requests import render_chunks
from rolecast.plans import manifest as M
from rolecast.session import finished, saved

REPLY_ORDER = ("night", "pass_no", "chunk_id", "line_no")
#: Chunks of a wave for each call that runs at a time.
CHUNKS_PER_CALL = 50
#: Waves in which a pass asks for everyone with chunks of the largest size, at most.
WAVES_PER_PASS = 64
TODO_SCHEMA = "prospect_id string, job_title string, row_no long, block long"
PARSED_SCHEMA = "pass_no int, chunk_id long, line_no int, prospect_id string, persona string, persona_certainty string"


def stage_contacts(contacts: DataFrame, path: str) -> DataFrame:
    """Write prepared contacts once, numbered, and read them from there on."""
    spark = contacts.sparkSession
    if not finished(spark, path):
        numbered = contacts if "seq" in contacts.columns else attach_seq(contacts)
        numbered.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def parsed_replies(raw: DataFrame) -> DataFrame:
    return tidy_replies(parse_reply_lines(keep_nonempty(raw), keep=("pass_no", "chunk_id"))).drop("shape", "job_title")


def stage_todo(todo: DataFrame, path: str, width: int) -> DataFrame:
    """Write who is asked in a pass, numbered in the order of `seq`, one folder per `width`
    rows, so that a wave reads its own rows only."""
    spark = todo.sparkSession
    if not finished(spark, path):
        numbered = number_rows(todo.select("prospect_id", "job_title", "seq")).drop("seq")
        blocks = numbered.withColumn("block", F.expr(f"(row_no - 1) div {int(width)}L"))
        blocks.write.mode("overwrite").partitionBy("block").parquet(path)
    return spark.read.schema(TODO_SCHEMA).parquet(path)


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    """All waves below a folder, whatever their number."""
    return spark.read.schema(REPLY_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def wave_log(replies: DataFrame) -> DataFrame:
    """What each wave of a reply table asked and met: the error table that sets the size of
    the chunks of the next."""
    limited = F.coalesce(X.is_rate_limit(F.col("error")), F.lit(False))
    return replies.groupBy("pass_no", "wave", "chunk_size").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum("n").alias("n_rows"),
        F.sum("attempts").alias("attempts"),
        F.count_if(limited).alias("rate_limited"),
        F.count("reply").alias("answered"),
        F.max("error").alias("last_error"),
    )


def next_chunk_size(size: int, rate_limited: int, smallest: int = S.MIN_CHUNK) -> int:
    """Half the size after a wave that ran into a rate limit, never more than before."""
    return min(size, max(smallest, size // 2)) if rate_limited else size


def ask_pass(
    todo: DataFrame,
    path: str,
    ask: ReplyFunction,
    size: int,
    smallest: int,
    chunks_per_wave: int,
    width: int,
    **call_options,
) -> tuple[bool, int]:
    """Ask wave by wave; whether there was anyone to ask, and the chunk size after the last.

    A wave is `chunks_per_wave` chunks of the size that the waves before it have left. Each is
    a finished table before the next begins, so a lost executor or a stopped run repeats the
    calls of one wave at most, and a run that goes on finds the sizes in the waves it has. No
    reply at all in a pass is an error: the service is down or the reply function wrong."""
    spark = todo.sparkSession
    calls = call_options.get("calls_in_parallel") or spark.sparkContext.defaultParallelism
    total = todo.agg(F.max("row_no")).first()[0] or 0
    start, first_chunk, wave, answered, error = 0, 0, 0, 0, None
    while start < total:
        wave_path = f"{path}/wave-{wave}"
        if not finished(spark, wave_path):
            end = start + size * chunks_per_wave
            rows = todo.filter(F.col("block").between(start // width, (end - 1) // width) & (F.col("row_no") > start) & (F.col("row_no") <= end))
            chunked = rows.withColumn("chunk_id", F.expr(f"{first_chunk}L + (row_no - 1 - {start}L) div {size}L"))
            ask_chunks(render_chunks(chunked, tasks=calls), ask, wave_path, wave=wave, chunk_size=size, **call_options)
        told = wave_log(spark.read.schema(REPLY_SCHEMA).parquet(wave_path)).first()
        start, first_chunk, wave = start + told["n_rows"], first_chunk + told["n_chunks"], wave + 1
        answered, error = answered + told["answered"], told["last_error"]
        size = next_chunk_size(told["chunk_size"], told["rate_limited"], smallest)
    if total and not answered:
        raise RuntimeError(f"no call was answered; the last error: {error}")
    return total > 0, size


def stage_parsed(replies: DataFrame, path: str) -> DataFrame:
    """Parse the replies of a pass once."""
    spark = replies.sparkSession
    if not finished(spark, path):
        parsed_replies(replies).write.mode("overwrite").parquet(path)
    return spark.read.schema(PARSED_SCHEMA).parquet(path)


def collect_replies(
    asked: DataFrame,
    ask: ReplyFunction,
    work_dir: str,
    taxonomy: Sequence[str] = S.PERSONAS,
    max_chunk: int = S.MAX_CHUNK,
    min_chunk: int = S.MIN_CHUNK,
    max_passes: int = S.MAX_PASSES,
    chunks_per_wave: int | None = None,
    **call_options,
) -> DataFrame:
    """Ask for all of `asked`, then again for those without a valid persona, in smaller chunks,
    and parse what comes back.

    `asked` is a staged table with one row per id. A run that was cut off goes on after its
    last finished wave. A wave has `chunks_per_wave` chunks, more if a pass would otherwise
    take over `WAVES_PER_PASS` of them: waves run one after the other and each has jobs of its
    own, so their number must not grow with the table. `call_options` go to `ask_chunks`.
    """
    spark = asked.sparkSession
    calls = call_options.get("calls_in_parallel") or spark.sparkContext.defaultParallelism
    chunks_per_wave = max(chunks_per_wave or CHUNKS_PER_CALL * calls, asked.count() // (max_chunk * WAVES_PER_PASS))
    width = max_chunk * chunks_per_wave
    parsed, size = spark.createDataFrame([], PARSED_SCHEMA), max_chunk
    for pass_no in range(1, max_passes + 1):
        todo_path, replies_path = f"{work_dir}/todo/pass-{pass_no}", f"{work_dir}/replies/pass-{pass_no}"
        todo = asked
        if pass_no > 1 and not finished(spark, todo_path):
            todo = saved(M.unanswered(asked, keep_valid_persona(parsed, taxonomy)), "todo")
            if todo.isEmpty():
                break
        staged = stage_todo(todo, todo_path, width)
        anyone, size = ask_pass(staged, replies_path, ask, size, min_chunk, chunks_per_wave, width, pass_no=pass_no, **call_options)
        if not anyone:
            break
        parsed = parsed.unionByName(stage_parsed(read_replies(spark, replies_path), f"{work_dir}/parsed/pass-{pass_no}"))
        size = max(min_chunk, size // 2)
    return parsed


def run_online(
    contacts: DataFrame,
    ask: ReplyFunction,
    work_dir: str,
    taxonomy: Sequence[str] = S.PERSONAS,
    threshold: int | None = S.FUZZY_THRESHOLD,
    keep: Sequence[str] = (),
    grow: bool = False,
    model: str = "",
    **options,
) -> DataFrame:
    """Decisions for prepared contacts. `options` go to `collect_replies`;
    `keep` hands on columns of the replies, such as `pass_no`.

    A work folder belongs to one set of parameters. The same call goes on where it stopped.
    With other contacts it is an error, unless the folder is to `grow`: then contacts that
    came later, or whose title changed, are asked for, and answers that still hold are taken
    over; other changed columns, such as addresses, are handed on as they are now. The reply
    function is code that may be mended between two calls, so it is no parameter; `model`
    names what answers, for those who want it to be one.

    Each id is asked for once, with the title of its first row by `seq`.
    """
    spark = contacts.sparkSession
    shown = {name: options[name] for name in ("max_chunk", "min_chunk", "max_passes", "system") if name in options}
    night = M.claim(spark, work_dir, M.fingerprint(contacts, taxonomy=list(taxonomy), model=model, **shown), grow)
    staged = stage_contacts(contacts, f"{M.night_dir(work_dir, night)}/contacts")
    before = earlier_answers(spark, work_dir, night, options.get("max_passes", S.MAX_PASSES))
    known = None if before is None else keep_valid_persona(before, taxonomy)
    folder = M.night_dir(work_dir, night)
    asked = M.stage_asked(staged, known, f"{folder}/asked")
    parsed = collect_replies(asked, ask, folder, taxonomy=taxonomy, **options)
    answers = M.stage_answers(asked, parsed, before, night, f"{folder}/answers")
    if before is not None:
        answers = saved(M.answers_for(staged, answers), "answers")
    return decide(staged, answers.drop("title"), REPLY_ORDER, taxonomy, threshold, keep=keep)


def earlier_answers(spark: SparkSession, work_dir: str, night: int, max_passes: int) -> DataFrame | None:
    """Answers of the nights before, also of one that was cut off: its finished waves count."""
    answers = None
    for past in range(1, night):
        folder = M.night_dir(work_dir, past)
        if not finished(spark, f"{folder}/asked"):
            continue
        if finished(spark, f"{folder}/answers"):
            answers = spark.read.parquet(f"{folder}/answers")
            continue
        waves = []
        for pass_no in range(1, max_passes + 1):
            wave = 0
            while finished(spark, path := f"{folder}/replies/pass-{pass_no}/wave-{wave}"):
                waves, wave = [*waves, path], wave + 1
        parsed = parsed_replies(spark.read.schema(REPLY_SCHEMA).parquet(*waves)) if waves else spark.createDataFrame([], PARSED_SCHEMA)
        answers = M.stage_answers(spark.read.parquet(f"{folder}/asked"), parsed, answers, past, f"{folder}/answers")
    return answers


def asked_per_pass(
    contacts: DataFrame, replies: DataFrame, last_pass: int = S.MAX_PASSES, taxonomy: Sequence[str] = S.PERSONAS
) -> DataFrame:
    """`pass_no`, `prospect_id` of every contact asked in a pass.

    A contact is asked in a pass when no earlier pass gave it a valid persona.
    """
    done = keep_valid_persona(replies, taxonomy).groupBy("prospect_id").agg(F.min("pass_no").alias("done_in"))
    upto = F.coalesce(F.col("done_in"), F.lit(last_pass))
    return (
        contacts.select("prospect_id")
        .join(done, "prospect_id", "left")
        .select(F.explode(F.sequence(F.lit(1), upto)).alias("pass_no"), "prospect_id")
    )
