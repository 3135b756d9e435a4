"""Queries on joins, decisions and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.fixtures import REPAIRED, VALID, base, fixture
from catalogue.registry import query, sql_list, sql_pairs
from catalogue.reply_queries import LAST_SQL, OBJECT_SQL, RESULT_COLUMNS, TIDY_SQL
from rolecast.functions import text as X
from rolecast.operators import clean, decide as D, repair, report
from rolecast.operators.replies import first_per_id, tidy_replies
from rolecast.plans.batch import finish_batch
from rolecast.plans.online import asked_per_pass
from rolecast.plans.rerun import finish_rerun
from rolecast.session import new_path, saved
from rolecast.sinks.outputs import write_decisions

ORDER = ("n", "persona", "persona_certainty")
VALID_SQL = sql_list(VALID)
GOLDEN_SQL = f"(values {sql_pairs(REPAIRED)}) as g(word, name)"
FIRST_SQL = "select * from replies qualify row_number() over (partition by prospect_id order by n, persona, persona_certainty) = 1"
REASON_SQL = f"""case when trim(coalesce(persona, '')) = '' then 'No LLM response'
    when trim(persona) not in ({VALID_SQL}) then 'Invalid persona: ' || trim(persona) end"""


def _chosen(repaired: str) -> str:
    return f"""select prospect_id, n, persona as given, persona_certainty, {repaired} as repaired
        from ({TIDY_SQL}) as t left join {GOLDEN_SQL} on t.persona = g.word
        qualify row_number() over (partition by prospect_id order by
            case when t.persona in ({VALID_SQL}) then 0 when {repaired} is not null then 1 else 2 end,
            n, t.persona nulls first, persona_certainty) = 1"""


def _decided(repaired: str) -> str:
    return f"""select *, {REASON_SQL} as skip_reason from (
        select p.prospect_id, p.seq, p.email, p.job_title,
               case when given in ({VALID_SQL}) then given else coalesce(repaired, given) end as persona,
               c.persona_certainty
        from prospects p left join ({_chosen(repaired)}) c on p.prospect_id = c.prospect_id)"""


DECIDED_SQL = _decided("g.name")
PLAIN_SQL = _decided("cast(null as varchar)")


def decisions(spark, sf, threshold=60):
    replies = tidy_replies(fixture(spark, sf, "replies"))
    return D.decide(fixture(spark, sf, "prospects"), replies, ORDER, threshold=threshold)


@query(
    f"""select p.*, r.n, r.persona, r.persona_certainty from prospects p
    left join ({FIRST_SQL}) r on p.prospect_id = r.prospect_id"""
)
def join_left(spark, sf):
    return D.join_replies(fixture(spark, sf, "prospects"), first_per_id(fixture(spark, sf, "replies"), list(ORDER)))


@query("select p.*, r.n, r.persona, r.persona_certainty from prospects p join replies r on p.prospect_id = r.prospect_id")
def join_inner(spark, sf):
    return D.answered_contacts(fixture(spark, sf, "prospects"), fixture(spark, sf, "replies"))


@query(f"select * from prospects where prospect_id not in (select prospect_id from replies where persona in ({VALID_SQL}))")
def join_anti(spark, sf):
    valid = clean.keep_valid_persona(fixture(spark, sf, "replies"))
    return D.contacts_without(fixture(spark, sf, "prospects"), valid)


@query(f"select * from prospects where prospect_id in (select prospect_id from replies where persona in ({VALID_SQL}))")
def join_semi(spark, sf):
    valid = clean.keep_valid_persona(fixture(spark, sf, "replies"))
    return D.contacts_within(fixture(spark, sf, "prospects"), valid)


@query(
    """select s.prospect_id, s.email, s.job_title, s.skip_reason, s.persona as persona_old,
    s.persona_certainty as persona_certainty_old, r.persona, r.persona_certainty, r.error
    from skipped s left join rerun_results r on s.prospect_id = r.prospect_id"""
)
def join_rerun(spark, sf):
    return D.join_rerun(fixture(spark, sf, "skipped"), fixture(spark, sf, "rerun_results"))


UPDATED_SQL = f"""select prospect_id, email, job_title, persona, persona_certainty,
    case when trim(coalesce(persona, '')) = '' then 'Batch error: ' || coalesce(error, 'No LLM response')
         else {REASON_SQL} end as skip_reason
    from (select s.prospect_id, s.email, s.job_title, coalesce(case when trim(r.persona) <> '' then r.persona end, s.persona) as persona,
                 coalesce(case when trim(r.persona_certainty) <> '' then r.persona_certainty end, s.persona_certainty) as persona_certainty,
                 r.error
          from skipped s left join rerun_results r on s.prospect_id = r.prospect_id)"""


@query(UPDATED_SQL)
def val_choose(spark, sf):
    return D.update_skipped(fixture(spark, sf, "skipped"), fixture(spark, sf, "rerun_results"))


@query(f"select prospect_id, n, persona, persona_certainty, {REASON_SQL} as skip_reason from replies")
def dec_skip_reason(spark, sf):
    return D.with_skip_reason(fixture(spark, sf, "replies"))


@query(
    f"""select p.prospect_id, p.seq, p.email, p.job_title, r.persona, r.persona_certainty,
    case when trim(coalesce(persona, '')) = '' then 'Batch error: ' || coalesce(error, 'No LLM response')
         else {REASON_SQL} end as skip_reason
    from prospects p left join (select {RESULT_COLUMNS} from ({OBJECT_SQL.replace('{0}', LAST_SQL)})) r
    on p.prospect_id = r.prospect_id"""
)
def dec_batch_reason(spark, sf):
    lines = fixture(spark, sf, "batch_output")
    return finish_batch(fixture(spark, sf, "prospects"), lines, ("line_no", "line"), threshold=None)


@query(f"select * from ({DECIDED_SQL}) where skip_reason is null")
def dec_split_accepted(spark, sf):
    return D.accepted(decisions(spark, sf))


@query(f"select * from ({DECIDED_SQL}) where skip_reason is not null")
def dec_split_skipped(spark, sf):
    return D.skipped(decisions(spark, sf))


def _corrected(spark, sf):
    decided = saved(decisions(spark, sf, None), "decisions")
    return decided, *repair.repair_skipped(D.skipped(decided))


@query(
    f"""select d.prospect_id, d.seq, d.email, d.job_title, coalesce(g.name, d.persona) as persona, d.persona_certainty
    from ({PLAIN_SQL}) d left join {GOLDEN_SQL} on d.persona = g.word
    where d.skip_reason is null or g.name is not null"""
)
def fix_merge_back(spark, sf):
    decided, corrected, _ = _corrected(spark, sf)
    return D.merge_corrected(D.accepted(decided), fixture(spark, sf, "prospects"), corrected)


@query(
    f"""select d.* from ({PLAIN_SQL}) d left join {GOLDEN_SQL} on d.persona = g.word
    where d.skip_reason is not null and g.name is null"""
)
def fix_still_skipped(spark, sf):
    return _corrected(spark, sf)[2]


@query(
    f"""select persona, count(*) as n, round(100.0 * count(*)::double / sum(count(*)) over ()::double, 6) as percent
    from ({DECIDED_SQL}) where skip_reason is null group by persona"""
)
def agg_distribution(spark, sf):
    return report.persona_distribution(D.accepted(decisions(spark, sf)))


@query(f"select skip_reason, count(*) as n from ({DECIDED_SQL}) where skip_reason is not null group by skip_reason")
def agg_reasons(spark, sf):
    return report.reason_counts(decisions(spark, sf))


@query(
    f"""select count(*) as total, count(*) filter (skip_reason is null) as accepted,
    count(*) filter (skip_reason is not null) as skipped from ({DECIDED_SQL})"""
)
def agg_summary(spark, sf):
    return report.run_summary(decisions(spark, sf))


@query(
    f"""select count(*) as total, count(*) filter (skip_reason is null) as accepted, count(*) filter (skip_reason is not null) as skipped,
    count(*) filter (skip_reason = 'No LLM response') as no_response, count(*) filter (starts_with(skip_reason, 'Invalid persona: ')) as invalid_persona,
    count(*) filter (starts_with(skip_reason, 'Batch error: ')) as batch_error from ({DECIDED_SQL})"""
)
def agg_written(spark, sf):
    """The summary of a run, counted while its decisions are written."""
    return write_decisions(decisions(spark, sf), new_path(spark, "decisions"))


@query(
    f"""with done as (select prospect_id, min(pass_no) as done_in from pass_replies where persona in ({VALID_SQL}) group by 1),
    asked as (select unnest(range(1, coalesce(done_in, 9) + 1)) as pass_no, p.prospect_id
              from prospects p left join done d on p.prospect_id = d.prospect_id),
    per_pass as (select pass_no, count(*) as asked from asked group by 1),
    hits as (select done_in as pass_no, count(*) as processed from done group by 1)
    select cast(a.pass_no as int) as pass_no, a.asked, coalesce(h.processed, 0) as processed,
           a.asked - coalesce(h.processed, 0) as remaining
    from per_pass a left join hits h on a.pass_no = h.pass_no"""
)
def agg_pass(spark, sf):
    replies = fixture(spark, sf, "pass_replies")
    asked = asked_per_pass(fixture(spark, sf, "prospects"), replies, last_pass=9)
    return report.pass_summary(asked, clean.keep_valid_persona(replies))


@query(
    """with jobs as (select batch_id, count(*) filter (outcome = 'completed') as completed,
        count(*) filter (outcome = 'failed') as failed, count(*) as total,
        cast(floor(epoch(min(logged_at))) as bigint) as started_at, cast(floor(epoch(max(logged_at))) as bigint) as seen_at
        from request_log group by 1)
    select batch_id, completed, failed, total,
    round(case when completed > 0 then greatest(0, total - completed)::double
          / (completed::double / greatest(1, seen_at - started_at)::double) end, 6) as eta_seconds from jobs"""
)
def agg_progress(spark, sf):
    progress = report.batch_progress(fixture(spark, sf, "request_log"), "logged_at")
    return progress.select("batch_id", "completed", "failed", "total", F.round("eta_seconds", 6).alias("eta_seconds"))


@query("select * from batch_jobs where coalesce(status, '') not in ('completed', 'failed', 'cancelled', 'canceled')")
def agg_open_batches(spark, sf):
    return report.open_batches(fixture(spark, sf, "batch_jobs"))


@query(
    """with jobs as (select *, coalesce(nullif(given_total, 0), completed + failed) as total, 1000000 - nullif(started_at, 0) as ago from batch_jobs)
    select batch_id, total, round(case when total > 0 and ago is not null and completed > 0
        then greatest(0, total - completed)::double / (completed::double / greatest(1, ago)::double) end, 6) as eta_seconds
    from jobs"""
)
def agg_eta(spark, sf):
    timed = report.with_eta(fixture(spark, sf, "batch_jobs"), F.lit(1000000).cast("long"))
    return timed.select("batch_id", "total", F.round("eta_seconds", 6).alias("eta_seconds"))


@query(
    """select event_id, case when event_type = 'signup' or event_type = 'view' then '—'
       when s >= 3600 then (s // 3600) || 'h ' || (s // 60 % 60) || 'm ' || (s % 60) || 's'
       when s >= 60 then (s // 60) || 'm ' || (s % 60) || 's' else s || 's' end as duration
    from (select event_id, event_type, cast(floor(value * value) as bigint) as s from events)"""
)
def fmt_duration(spark, sf):
    events = base(spark, sf, "events")
    seconds = (
        F.when(F.col("event_type") == "view", F.lit(-1.0))
        .when(F.col("event_type") != "signup", F.col("value") * F.col("value"))
    )
    return events.select("event_id", X.duration_text(seconds).alias("duration"))


@query(
    """select chunk_size, count(*) as n, round(avg(skipped::double), 9) as skip_rate,
    round(0.9::double * sum(count(*)) over ()::double * avg(skipped::double), 3) as target_chunk
    from run_log group by chunk_size"""
)
def agg_skip_rate(spark, sf):
    return report.skip_rate_by_chunk(fixture(spark, sf, "run_log"))


@query("select * from prospects where prospect_id not in (select prospect_id from replies)")
def out_resume(spark, sf):
    return D.contacts_without(fixture(spark, sf, "prospects"), fixture(spark, sf, "replies"))


@query(f"select * from ({DECIDED_SQL}) where skip_reason is null order by seq limit 5")
def out_head(spark, sf):
    return D.accepted(decisions(spark, sf)).orderBy("seq").limit(5)


RESULTS_SQL = f"select {RESULT_COLUMNS} from ({OBJECT_SQL.replace('{0}', LAST_SQL)})"
BLANK_SQL = "trim(n.prospect_id) = ''"


@query(
    f"""select 'online' as mode, n.prospect_id, n.seq, n.email, n.job_title,
    case when not {BLANK_SQL} then d.persona end as persona, case when not {BLANK_SQL} then d.persona_certainty end as persona_certainty,
    case when {BLANK_SQL} then 'No LLM response' else d.skip_reason end as skip_reason
    from nameless n join ({PLAIN_SQL}) d on n.seq = d.seq
    union all
    select 'batch', n.prospect_id, n.seq, n.email, n.job_title, r.persona, r.persona_certainty,
    case when trim(coalesce(persona, '')) = '' then 'Batch error: ' || coalesce(error, 'No LLM response') else {REASON_SQL} end
    from nameless n left join ({RESULTS_SQL}) r on n.prospect_id = r.prospect_id and not {BLANK_SQL}"""
)
def dec_blank_ids(spark, sf):
    """Contacts without an id are rows of their own, online and in a batch."""
    contacts = fixture(spark, sf, "nameless")
    online = D.decide(contacts, tidy_replies(fixture(spark, sf, "replies")), ORDER, threshold=None)
    batch = finish_batch(contacts, fixture(spark, sf, "batch_output"), ("line_no", "line"), threshold=None)
    columns = ("prospect_id", "seq", "email", "job_title", "persona", "persona_certainty", "skip_reason")
    return online.select(F.lit("online").alias("mode"), *columns).unionByName(batch.select(F.lit("batch").alias("mode"), *columns))


@query("select p.*, r.n, r.persona, r.persona_certainty from prospects p join replies r on p.prospect_id = r.prospect_id")
def join_inner_salted(spark, sf):
    """As `join_inner` with hot ids spread over tasks."""
    return D.answered_contacts(fixture(spark, sf, "prospects"), fixture(spark, sf, "replies"), max_rows=0, hot_rows=3)


@query(
    """select s.prospect_id, s.email, s.job_title, s.skip_reason, s.persona as persona_old,
    s.persona_certainty as persona_certainty_old, r.persona, r.persona_certainty, r.error
    from skipped s left join rerun_results r on s.prospect_id = r.prospect_id"""
)
def join_rerun_salted(spark, sf):
    return D.join_rerun(fixture(spark, sf, "skipped"), fixture(spark, sf, "rerun_results"), max_rows=0, hot_rows=0)


@query(
    f"""select p.prospect_id, p.seq, p.email, p.job_title, coalesce(g.name, r.persona) as persona, r.persona_certainty,
    case when trim(coalesce(persona, '')) = '' then 'Batch error: ' || coalesce(error, 'No LLM response')
         when g.name is null then {REASON_SQL} end as skip_reason
    from prospects p left join ({RESULTS_SQL}) r on p.prospect_id = r.prospect_id left join {GOLDEN_SQL} on r.persona = g.word"""
)
def run_batch_repair(spark, sf):
    """A finished batch with near misses of a name repaired."""
    return finish_batch(fixture(spark, sf, "prospects"), fixture(spark, sf, "batch_output"), ("line_no", "line"))


@query(UPDATED_SQL.replace("rerun_results r", f"({RESULTS_SQL}) r"))
def run_rerun(spark, sf):
    """A whole rerun: lines of a batch to new values and reasons of skipped contacts."""
    return finish_rerun(fixture(spark, sf, "skipped"), fixture(spark, sf, "batch_output"), ("line_no", "line"))
