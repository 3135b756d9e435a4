"""Queries on sources, the classifier call, intake and sinks."""

from __future__ import annotations

import csv
import io
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import PythonException
from pyspark.sql import Window, functions as F

from catalogue.clean_queries import MARKER, RULES_SQL
from catalogue.decision_queries import DECIDED_SQL, UPDATED_SQL, decisions
from catalogue.fixtures import base, fixture
from catalogue.registry import query
from rolecast import schema as S
from rolecast.operators.classify import CallFailed, RetryPolicy, ask_chunks, rule_replies
from rolecast.operators.clean import prepare_contacts, require_rows
from rolecast.operators.decide import update_skipped
from rolecast.operators.numbering import assign_chunks
from rolecast.operators.replies import parse_reply_lines
from rolecast.operators.requests import render_chunks, request_documents
from rolecast.plans.online import read_replies, run_online, wave_log
from rolecast.session import new_path, saved, scratch
from rolecast.sinks.outputs import save_outputs, write_csv, write_lines
from rolecast.sources.archive import read_archives, unpack_archives
from rolecast.sources.contacts import read_contacts, read_csv_contacts, read_skipped, union_sheets
from rolecast.sources.text import read_instructions, read_lines
from rolecast.streaming.intake import take_in
from rolecast.streaming.nightly import run_nightly

DISPLAY = {"prospect_id": "Record ID", "email": "Email", "job_title": "Job Title"}
PREPARED_SQL = "select * from prospects where not contains(email, '@internal') and trim(job_title) <> ''"


@query("select prospect_id, first_name, company from sheets where sheet <> 'HubSpot Export Summary'")
def src_sheet_union(spark, sf):
    return union_sheets(fixture(spark, sf, "sheets"), ("prospect_id", "first_name", "company"))


def _zip_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One export archive per Arrow batch, with a summary beside the contact table."""
    for number, batch in enumerate(batches):
        table = io.StringIO()
        writer = csv.writer(table)
        writer.writerow(DISPLAY[name] for name in batch.columns)
        writer.writerows(batch.itertuples(index=False))
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("hubspot-export-summary.csv", "a,b\n1,2\n")
            archive.writestr(S.ARCHIVE_MEMBER, table.getvalue())
        yield pd.DataFrame({"path": [f"export-{number}.zip"], "content": [packed.getvalue()]})


@query("select prospect_id, email, job_title from prospects")
def src_archive(spark, sf):
    contacts = fixture(spark, sf, "prospects").select(*DISPLAY)
    archives = contacts.mapInPandas(_zip_rows, "path string, content binary")
    return unpack_archives(archives).select(*DISPLAY)


@query("select prospect_id, email, job_title from prospects")
def src_csv(spark, sf):
    """Contacts written as CSV with quoted commas and read back."""
    path = new_path(spark, "csv")
    contacts = fixture(spark, sf, "prospects").select(*DISPLAY)
    write_csv(contacts.withColumnsRenamed(DISPLAY), path)
    return read_csv_contacts(spark, path).select(*DISPLAY)


HEADERS = (
    ("Record ID", "Email", "Job Title"),
    ("Record ID", "First Name", "Job Title", "Email"),
    ("Job Title", "Owner", "Email", "Record ID", "Company"),
)


def _exports(contacts, folder: str) -> None:
    """Exports of three kinds, with columns in different orders, some of them extra."""
    wide = contacts.withColumnsRenamed(DISPLAY).withColumns({name: F.lit("other") for name in ("First Name", "Owner", "Company")})
    for kind, header in enumerate(HEADERS):
        write_csv(wide.filter(F.col("seq") % len(HEADERS) == kind).select(*header), f"{folder}/kind-{kind}")


@query(
    """select prospect_id, email, job_title, case when seq % 3 = 1 then 'other' else '' end as first_name,
    case when seq % 3 = 2 then 'other' else '' end as company from prospects"""
)
def src_csv_headers(spark, sf):
    """Files whose headers differ, read as one table by the names of the columns."""
    root = new_path(spark, "csv")
    _exports(fixture(spark, sf, "prospects"), root)
    read = read_contacts(spark, f"{root}/*/")
    return read.select(*DISPLAY, "first_name", "company").fillna("")


@query(f"select prospect_id, email, job_title from ({PREPARED_SQL})")
def src_stream(spark, sf):
    """Two nights of intake with headers of three kinds; the second only takes in what is new."""
    root = new_path(spark, "intake")
    contacts = fixture(spark, sf, "prospects")
    early = F.col("email").rlike("contest.example|building.example")
    for night, part in enumerate((contacts.filter(early), contacts.filter(~early))):
        _exports(part, f"{root}/drop/night-{night}")
        take_in(spark, f"{root}/drop/*/*", f"{root}/out", f"{root}/state", prepare=_prepare)
    return spark.read.parquet(f"{root}/out").select(*DISPLAY)


def _prepare(df):
    return prepare_contacts(df, MARKER)


LONG = 131_073  # longer than the usual limit of a CSV cell


ARCHIVE_CHARS = 32_000_000


def _quoted(cells: list[str | None], times: int = 1) -> str:
    """Cells of a CSV table, the second of them so many times over."""
    texts = ['"' + (cell or "").replace('"', '""') * (times if i == 1 else 1) + '"' for i, cell in enumerate(cells)]
    return ",".join(texts) + "\r\n"


def _pack_files(folder: str):
    """Writes archives of about `ARCHIVE_CHARS` each to `folder`, which all executors reach.
    Titles are repeated here until they are longer than `LONG`."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            rows = batch.itertuples(index=False)
            row = next(rows, None)
            while row is not None:
                packed, chars = io.BytesIO(), 0
                with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive, archive.open(S.ARCHIVE_MEMBER, "w") as table:
                    table.write(_quoted(batch.columns.tolist()).encode())
                    while row is not None and chars < ARCHIVE_CHARS:
                        line = _quoted(list(row), 1 + LONG // max(1, len(row[1] or "")))
                        table.write(line.encode())
                        chars, row = chars + len(line), next(rows, None)
                store, path = fs.FileSystem.from_uri(f"{folder}/export-{uuid.uuid4().hex}.zip")
                store.create_dir(path.rpartition("/")[0], recursive=True)
                with store.open_output_stream(path) as out:
                    out.write(packed.getvalue())
                yield pd.DataFrame({"path": [path]})

    return pack


@query(
    f"""select cast(doc_id as string) as prospect_id, lang as "Lead Language", source as "Lead Source",
    cast(length(text) * (1 + {LONG} // greatest(length(text), 1)) as int) as n_chars from documents"""
)
def src_archive_files(spark, sf):
    """Zipped exports as files: very long cells, and columns that the library does not know."""
    rows = base(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("Record ID"), F.col("text").alias("Job Title"), F.col("lang").alias("Lead Language"), F.col("source").alias("Lead Source")
    )
    folder = new_path(spark, "archives")
    paths = saved(rows.mapInPandas(_pack_files(folder), "path string"), "packed")
    require_rows(paths)
    read = read_archives(spark, folder)
    return read.select("prospect_id", "Lead Language", "Lead Source", F.length("job_title").alias("n_chars"))


WIDE = 40_000
ROUND_BYTES = 2 << 30
ROUNDS = 24
FILE_BYTES = 160 << 20  # more than a split
WIDE_SQL = f"""repeat(coalesce(text, '') || chr(10) || '"a, b"' || chr(10), cast(1 + {WIDE} // (10 + length(coalesce(text, ''))) as int))"""


@query(
    f"""select cast(doc_id as string) as prospect_id, coalesce(source, '') as company, cast(length({WIDE_SQL}) as int) as n_chars,
    md5({WIDE_SQL}) as digest from documents"""
)
def src_csv_split(spark, sf):
    """Files larger than a split whose cells hold line breaks and quotes: each is many tasks,
    and many records lie across the edges of splits.

    The files are some twenty times the documents, so these are dealt to rounds of about
    `ROUND_BYTES` of files, or to `ROUNDS` larger ones, and the files of a round go once their
    digests are saved. All cores write them, as long as files are longer than `FILE_BYTES`."""
    documents = base(spark, sf, "documents").select("doc_id", "source", "text")
    repeats = F.expr(f"1 + {WIDE} div (10 + length(coalesce(text, '')))")
    size = documents.agg(F.sum((F.coalesce(F.octet_length("text"), F.lit(0)) + 10) * repeats)).first()[0] or 0
    rounds = min(ROUNDS, 1 + size // ROUND_BYTES)
    cores = spark.sparkContext.defaultParallelism
    files = max(1, cores // 4, min(cores, size // rounds // FILE_BYTES))
    dealt, digests = new_path(spark, "dealt"), new_path(spark, "digests")
    placed = documents.withColumn("round", F.pmod(F.xxhash64("doc_id", "source", "text"), F.lit(rounds)))
    placed.write.partitionBy("round").parquet(dealt)
    names = "prospect_id string, company string, n_chars int, digest string"
    spark.createDataFrame([], names).write.parquet(digests)
    for number in range(rounds):
        own = spark.read.schema(placed.schema).parquet(dealt).filter(F.col("round") == number)
        rows = own.select(
            F.col("doc_id").cast("string").alias("Record ID"), F.col("source").alias("Company"), F.expr(WIDE_SQL.replace("//", "div").replace("chr(", "char(")).alias("Job Title")
        )
        with scratch(spark):
            path = new_path(spark, "csv")
            write_csv(rows.coalesce(files), path)
            read = read_csv_contacts(spark, path)
            told = read.select("prospect_id", "company", F.length("job_title").alias("n_chars"), F.md5("job_title").alias("digest"))
            told.write.mode("append").parquet(digests)
    return spark.read.schema(names).parquet(digests)


@query(
    """select string_agg(r_name, chr(10) order by r_name) || chr(10) || string_agg(r_name, '; ' order by r_name desc) || chr(10)
    as system_text from region"""
)
def src_instructions(spark, sf):
    """The two instruction files of a run as one text."""
    names = base(spark, sf, "region").agg(F.sort_array(F.collect_list("r_name")).alias("names"))
    paths = []
    for part, text in (("frame", F.array_join("names", "\n")), ("personas", F.array_join(F.reverse("names"), "; "))):
        paths.append(write_lines(names.select(text.alias("line")).coalesce(1), new_path(spark, part)))
    texts = [f"{path}/*.txt" for path in paths]
    return spark.createDataFrame([(read_instructions(spark, *texts),)], "system_text string")


@query(PREPARED_SQL)
def flt_empty_guard(spark, sf):
    """Rows pass the guard that stops a run without any."""
    return require_rows(prepare_contacts(fixture(spark, sf, "prospects"), MARKER))


@query(
    """select prospect_id, 'POST' as method, 'Prospect Id: ' || prospect_id || chr(10) || 'Job Title: '
    || replace(job_title, ',', ' ') || chr(10) || chr(10) || 'Return ONLY the JSON.' as user_text from prospects"""
)
def src_request_lines(spark, sf):
    """The request file as a later job reads it."""
    documents = request_documents(fixture(spark, sf, "prospects"), "Sort the title.")
    lines = read_lines(spark, write_lines(documents, new_path(spark, "requests"), "request"))
    return lines.select(
        F.get_json_object("line", "$.custom_id").alias("prospect_id"),
        F.get_json_object("line", "$.method").alias("method"),
        F.get_json_object("line", "$.body.messages[1].content").alias("user_text"),
    )


@query(
    f"""select prospect_id, replace(job_title, ',', ' ') as job_title,
    {RULES_SQL.replace("job_title", "replace(job_title, ',', ' ')")} as persona, '90' as persona_certainty from prospects"""
)
def cls_mapinpandas(spark, sf):
    payloads = render_chunks(assign_chunks(fixture(spark, sf, "prospects"), S.MAX_CHUNK))
    raw = ask_chunks(payloads, rule_replies(), new_path(spark, "replies"))
    parsed = parse_reply_lines(raw).select(*S.REPLY_COLUMNS)
    return parsed.withColumn("job_title", F.coalesce("job_title", F.lit("")))


def _forgetful(system: str, payload: str) -> str:
    """Leaves out directors in long chunks, as a model does when asked too much at once."""
    answer = rule_replies()(system, payload)
    lines = answer.split("\n")
    return answer if len(lines) < 100 else "\n".join(line for line in lines if "Director" not in line)


QUIET = RetryPolicy(sleep=lambda s: None)
RUN_SQL = f"""select prospect_id, email, job_title, {RULES_SQL} as persona, '90' as persona_certainty,
    cast(null as varchar) as skip_reason from ({PREPARED_SQL})"""
# A chunk of 100 lines or more loses its directors. The last chunk of a pass may be shorter.
PASSES_SQL = f"""with one as (select prospect_id, seq, contains(job_title, 'Director') as director,
        row_number() over (order by seq) - 1 as r, count(*) over () as n from ({PREPARED_SQL})),
    two as (select prospect_id, row_number() over (order by seq) - 1 as r, count(*) over () as n from one
            where director and least(250, n - r // 250 * 250) >= 100),
    three as (select prospect_id from two where least(125, n - r // 125 * 125) >= 100)
    select d.*, cast(case when d.prospect_id in (select prospect_id from three) then 3
        when d.prospect_id in (select prospect_id from two) then 2 else 1 end as int) as pass_no from ({RUN_SQL}) d"""


@query(PASSES_SQL)
def cls_passes(spark, sf):
    """Up to three passes; what the first leaves out, a later one with smaller chunks answers."""
    contacts = prepare_contacts(fixture(spark, sf, "prospects"), MARKER)
    decided = run_online(contacts, _forgetful, new_path(spark, "online"), policy=QUIET, keep=("pass_no",))
    return decided.select(*S.DECISION_COLUMNS, "pass_no")


def _breaks_off(system: str, payload: str) -> str:
    """Fails for good at some chunk, as a client with a mistake in it does."""
    if "7,Founder" in payload:
        raise ValueError("broken off")
    return rule_replies()(system, payload)


@query(RUN_SQL)
def cls_resume(spark, sf):
    """A run that broke off goes on in its folder with what it has."""
    contacts = prepare_contacts(fixture(spark, sf, "prospects"), MARKER)
    work = new_path(spark, "online")
    try:
        run_online(contacts, _breaks_off, work, policy=QUIET, chunks_per_wave=8)
    except PythonException as error:
        if "broken off" not in str(error):
            raise
    return run_online(contacts, rule_replies(), work, policy=QUIET, chunks_per_wave=8).select(*S.DECISION_COLUMNS)


TODAY_SQL = f"""select prospect_id, email as old_email, case when contains(email, 'building.example') then 'new.' || email else email end as email,
    case when contains(email, 'machinery.example') then 'Chief ' || job_title else job_title end as job_title from ({PREPARED_SQL})"""


def _nobody(system: str, payload: str) -> str:
    raise ValueError("nobody was to be asked")


@query(
    f"""select prospect_id, email, job_title, {RULES_SQL} as persona, cast(null as varchar) as skip_reason,
    case when contains(old_email, 'contest.example') or contains(old_email, 'machinery.example') then '80' else '90' end as persona_certainty
    from ({TODAY_SQL})"""
)
def run_growing(spark, sf):
    """Three runs in one folder. The second has new contacts, changed titles, changed addresses
    and doubled rows; only the first two kinds are asked, by a model of another certainty. The
    third has nothing new and asks nobody."""
    contacts = saved(prepare_contacts(fixture(spark, sf, "prospects"), MARKER), "prepared")
    work, domain = new_path(spark, "online"), F.substring_index("email", "@", -1)
    options = {"policy": QUIET, "grow": True}
    run_online(contacts.filter(domain != "contest.example"), rule_replies(certainty="90"), work, **options)
    today = contacts.withColumns(
        {
            "email": F.when(domain == "building.example", F.concat(F.lit("new."), "email")).otherwise(F.col("email")),
            "job_title": F.when(domain == "machinery.example", F.concat(F.lit("Chief "), "job_title")).otherwise(F.col("job_title")),
        }
    )
    doubled = today.filter(domain == "household.example").withColumns({"seq": F.col("seq") + 10**15, "email": F.lit("late@second.example")})
    everyone = saved(today.unionByName(doubled), "today")
    run_online(everyone, rule_replies(certainty="80"), work, **options)
    return run_online(everyone, _nobody, work, **options).select(*S.DECISION_COLUMNS)


def _heard(folder: str):
    """The rule classifier; each id that it is asked for leaves a row in `folder`."""
    from pyarrow import fs

    answer = rule_replies()

    def ask(system: str, payload: str) -> str:
        store, path = fs.FileSystem.from_uri(f"{folder}/{uuid.uuid4().hex}.txt")
        store.create_dir(path.rpartition("/")[0], recursive=True)
        with store.open_output_stream(path) as out:
            out.write("\n".join(line.partition(",")[0] for line in payload.split("\n")).encode() + b"\n")
        return answer(system, payload)

    return ask


@query(
    f"""with nights as (select *, 1 as night from ({PREPARED_SQL}) where not contains(email, 'contest.example')
        union all select *, 2 from ({PREPARED_SQL}) where not contains(email, 'building.example'))
    select n.prospect_id, n.email, n.job_title, {RULES_SQL} as persona, cast(night as int) as night, cast(1 as bigint) as n_asked from nights n"""
)
def run_nights(spark, sf):
    """Two nights whose files overlap, as one stream: every contact is asked once."""
    root, domain = new_path(spark, "nights"), F.substring_index("email", "@", -1)
    contacts = saved(fixture(spark, sf, "prospects"), "contacts")
    for night, other in enumerate(("contest.example", "building.example"), 1):
        part = contacts.filter(domain != other).select(*DISPLAY).withColumnsRenamed(DISPLAY)
        write_csv(part, f"{root}/drop/night-{night}")
        decided = run_nightly(spark, f"{root}/drop/*", f"{root}/work", _heard(f"{root}/asked"), prepare=_prepare, policy=QUIET)
    asked = spark.read.text(f"{root}/asked").groupBy(F.col("value").alias("prospect_id")).agg(F.count(F.lit(1)).alias("n_asked"))
    night = F.dense_rank().over(Window.orderBy("batch_id"))
    batches = decided.select("batch_id").distinct().select("batch_id", night.cast("int").alias("night"))
    told = decided.join(F.broadcast(batches), "batch_id").join(asked, "prospect_id", "left")  # one row per batch
    return told.select("prospect_id", "email", "job_title", "persona", "night", "n_asked")


TOO_LONG, CONTACTS_PER_CHUNK = 100, 800


def _hurried(system: str, payload: str) -> str:
    if payload.count("\n") >= TOO_LONG:
        raise CallFailed("429: rate limit reached, try again in 0.5s")
    return rule_replies()(system, payload)


WAVES_SQL = f"""with recursive people as (select count(*) as n, greatest(1, count(*) // {CONTACTS_PER_CHUNK}) as chunks from ({PREPARED_SQL})),
    waves(pass_no, wave, size, first, total, failed, chunks) as (
        select 1, 0, 250, 0::bigint, n, 0::bigint, chunks from people where n > 0
        union all
        select if(last, pass_no + 1, pass_no), if(last, 0, wave + 1), if(last, greatest(10, halved // 2), halved), if(last, 0, first + w),
               if(last, failed + lost, total), if(last, 0, failed + lost), chunks
        from (select *, first + w >= total as last, if(lost > 0, greatest(10, size // 2), size) as halved
              from (select *, if(size > {TOO_LONG}, w // size * size, 0) + if(w % size > {TOO_LONG}, w % size, 0) as lost
                    from (select *, least(size * chunks, total - first) as w from waves)))
        where not last or pass_no < 3 and failed + lost > 0
    ),
    sized as (select *, least(size * chunks, total - first) as w from waves)
    select cast(pass_no as int) as pass_no, cast(wave as bigint) as wave, cast(size as int) as chunk_size, cast((w + size - 1) // size as bigint) as n_chunks,
           cast(w as bigint) as n_rows, cast((w + size - 1) // size + 4 * limited as bigint) as attempts, cast(limited as bigint) as rate_limited
    from (select *, if(size > {TOO_LONG}, w // size, 0) + if(w % size > {TOO_LONG}, 1, 0) as limited from sized)"""


@query(WAVES_SQL)
def cls_waves(spark, sf):
    """Waves of a run whose service refuses long requests: each wave's chunks are half as long
    as those of a wave that was refused."""
    contacts = saved(prepare_contacts(fixture(spark, sf, "prospects"), MARKER), "prepared")
    work = new_path(spark, "online")
    run_online(contacts, _hurried, work, policy=QUIET, chunks_per_wave=max(1, contacts.count() // CONTACTS_PER_CHUNK))
    return wave_log(read_replies(spark, f"{work}/replies")).drop("answered", "last_error")


@query(
    f"""select prospect_id, email, job_title, coalesce(persona, '') as persona,
    coalesce(persona_certainty, '') as persona_certainty, coalesce(skip_reason, '') as skip_reason from ({DECIDED_SQL})"""
)
def sink_roundtrip(spark, sf):
    """Accepted and skipped files, read back together."""
    decided = saved(decisions(spark, sf), "decisions")
    paths = save_outputs(decided, new_path(spark, "outputs"))
    return read_csv_contacts(spark, list(paths)).select(*S.DECISION_COLUMNS)


@query(
    f"""select prospect_id, email, job_title, nullif(persona, '') as persona,
    nullif(persona_certainty, '') as persona_certainty, skip_reason from ({UPDATED_SQL})"""
)
def sink_rerun_roundtrip(spark, sf):
    """Files of a rerun, quoted only where needed, with titles of many lines, read back as skipped files are."""
    updated = saved(update_skipped(fixture(spark, sf, "skipped"), fixture(spark, sf, "rerun_results")), "rerun")
    paths = save_outputs(updated, new_path(spark, "outputs"), rerun=True)
    both = [read_skipped(spark, path).select(*S.DECISION_COLUMNS) for path in paths]
    return both[0].unionByName(both[1])
