"""Queries on CRM tables and the write-back."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from catalogue.fixtures import base, fixture
from catalogue.registry import query
from rolecast.operators import crm
from rolecast.operators.classify import CallFailed, RetryPolicy
from rolecast.operators.clean import ensure_columns
from rolecast.plans.crm_sync import prepare_updates, reconcile
from rolecast.session import new_path, saved
from rolecast.sinks.delivery import block_outcomes, deliver, read_ledger
from rolecast.sources import crm as source
from rolecast.sources.contacts import CrmTables, read_contacts

MEMBERS_SQL = """select distinct coalesce(nullif(contact_id, ''), nullif(record_id, '')) as member_id
    from memberships where coalesce(nullif(contact_id, ''), nullif(record_id, '')) is not null and list_id"""
LIST_FORM_SQL = """coalesce(nullif(hs_object_id, ''), id, '') as prospect_id, coalesce(email, '') as email,
    coalesce(jobtitle, '') as job_title, coalesce(company, '') as company"""
REPORT_FORM_SQL = """coalesce(hs_object_id, '') as prospect_id, coalesce(email, '') as email,
    coalesce(jobtitle, '') as job_title, coalesce(firstname, '') as first_name, coalesce(lastname, '') as last_name,
    coalesce(company, '') as company"""
# Fixed values of the CRM, spelled out apart from the library's own.
ENUM_SQL = """case lower(trim(persona))
    when 'application developer' then 'persona_1' when 'executive sponsor' then 'persona_2'
    when 'economic buyer' then 'persona_3' when 'data product manager/owner' then 'persona_4'
    when 'data user' then 'persona_5' when 'real-time specialist' then 'persona_6'
    when 'operator/systems administrator' then 'persona_7' when 'technical decision maker' then 'persona_8'
    when 'not a target' then 'persona_9' else trim(persona) end"""
FOUND_SQL = f"""select lower(email) as email_key, prospect_id as found_id
    from (select {LIST_FORM_SQL} from crm_flat) where email <> '' and prospect_id <> ''
    qualify row_number() over (partition by lower(email) order by length(prospect_id), prospect_id) = 1"""
RESOLVED_SQL = f"""select a.*, coalesce(nullif(trim(a.prospect_id), ''), f.found_id) as contact_id,
    case when trim(a.prospect_id) <> '' then 'own' when f.found_id is not null then 'email' else 'not_found' end as id_source
    from accepted_rows a left join ({FOUND_SQL}) f on lower(a.email) = f.email_key
    where a.email is not null and a.persona is not null"""
BLOCKED_SQL = f"""select *, row_number() over (order by seq) as row_no,
    (row_number() over (order by seq) - 1) // 100 + 1 as block_no
    from ({RESOLVED_SQL}) where contact_id is not null"""


def nested(spark, sf):
    flat = fixture(spark, sf, "crm_flat")
    return flat.select("id", F.struct(*[name for name in flat.columns if name != "id"]).alias("properties"))


def resolved(spark, sf):
    known = source.flatten_list_contacts(nested(spark, sf))
    return saved(crm.resolve_ids(fixture(spark, sf, "accepted_rows"), known, ("seq",)), "resolved")


def report_lists(spark):
    return spark.createDataFrame([("7", "1-URGENT"), ("7", "5-LOW")], "report_id string, list_id string")


@query(f"select {LIST_FORM_SQL} from crm_flat")
def crm_flatten(spark, sf):
    return source.flatten_list_contacts(nested(spark, sf))


@query(f"select {REPORT_FORM_SQL} from crm_flat")
def crm_flatten_report(spark, sf):
    return source.flatten_report_contacts(nested(spark, sf))


@query(
    f"""select {LIST_FORM_SQL} from crm_flat
    where coalesce(nullif(hs_object_id, ''), id) in ({MEMBERS_SQL} = '2-HIGH')"""
)
def crm_list(spark, sf):
    return source.list_contacts(nested(spark, sf), fixture(spark, sf, "memberships"), "2-HIGH", limit=None)


@query(
    f"""select {LIST_FORM_SQL} from crm_flat where coalesce(nullif(hs_object_id, ''), id) in
    (select member_id from ({MEMBERS_SQL} = '2-HIGH') order by length(member_id), member_id limit 50)"""
)
def crm_list_first(spark, sf):
    """The row cap of a list pull: its 50 smallest ids."""
    return source.list_contacts(nested(spark, sf), fixture(spark, sf, "memberships"), "2-HIGH", limit=50)


@query(f"select {REPORT_FORM_SQL} from crm_flat where id in ({MEMBERS_SQL} in ('1-URGENT', '5-LOW'))")
def crm_report(spark, sf):
    return source.report_contacts(
        nested(spark, sf), fixture(spark, sf, "memberships"), report_lists(spark), "7", limit=None
    )


@query(f"select {REPORT_FORM_SQL} from crm_flat")
def crm_report_all(spark, sf):
    """A report without lists takes in every contact."""
    return source.report_contacts(
        nested(spark, sf), fixture(spark, sf, "memberships"), report_lists(spark), "8", limit=None
    )


@query("select prospect_id, email, job_title, '' as company from prospects")
def crm_ensure_columns(spark, sf):
    return ensure_columns(fixture(spark, sf, "prospects").drop("seq"))


@query(f"select *, {ENUM_SQL} as persona_enum from accepted_rows")
def crm_enum(spark, sf):
    return crm.with_enum(fixture(spark, sf, "accepted_rows"))


@query("select distinct trim(email) as email from accepted_rows where email is not null")
def crm_emails(spark, sf):
    return crm.lookup_emails(fixture(spark, sf, "accepted_rows").filter("email is not null"))


@query(f"select * from ({FOUND_SQL}) where email_key in (select lower(email) from accepted_rows)")
def crm_email_id(spark, sf):
    known = source.flatten_list_contacts(nested(spark, sf))
    return crm.ids_by_email(crm.lookup_emails(fixture(spark, sf, "accepted_rows")), known)


@query(RESOLVED_SQL)
def crm_ids(spark, sf):
    return resolved(spark, sf)


@query(
    f"""select seq, contact_id as id, {ENUM_SQL} as persona, persona_certainty
    from ({RESOLVED_SQL}) where contact_id is not null"""
)
def crm_records(spark, sf):
    form = "id STRING, properties STRUCT<hs_persona: STRING, persona_certainty: STRING>"
    records = crm.update_records(resolved(spark, sf)).select("seq", F.from_json("record", form).alias("r"))
    return records.select(
        "seq", "r.id", F.col("r.properties.hs_persona").alias("persona"), "r.properties.persona_certainty"
    )


BLOCKS_SQL = f"select block_no, count(*) as n, string_agg(contact_id, ',' order by row_no) as ids from ({BLOCKED_SQL}) group by block_no"


@query(BLOCKS_SQL)
def crm_blocks(spark, sf):
    blocks = crm.update_blocks(crm.update_records(resolved(spark, sf)))
    inputs = F.from_json("payload", "inputs ARRAY<STRUCT<id: STRING>>")["inputs"]
    return blocks.select("block_no", "n", F.array_join(inputs["id"], ",").alias("ids"))


@query(RESOLVED_SQL)
def crm_ids_salted(spark, sf):
    """As `crm_ids` with the join that spreads hot addresses."""
    known = source.flatten_list_contacts(nested(spark, sf))
    return crm.resolve_ids(fixture(spark, sf, "accepted_rows"), known, ("seq",), max_rows=0, hot_rows=3)


@query(
    f"""select count(*) filter (result = 'success') as success, count(*) filter (result = 'failed') as failed,
    count(*) filter (result = 'not_found') as not_found from (
        select case when exists (select 1 from orders where o_orderkey = block_no and o_orderstatus = 'F')
               then 'failed' else 'success' end as result from ({BLOCKED_SQL})
        union all select 'not_found' from ({RESOLVED_SQL}) where contact_id is null)"""
)
def run_updates(spark, sf):
    """A whole write-back: ids, blocks, outcomes, totals."""
    known = source.flatten_list_contacts(nested(spark, sf))
    found, blocks = prepare_updates(fixture(spark, sf, "accepted_rows"), known)
    failed = base(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("block_no"), F.lit(True).alias("bad"))
    status = F.when(F.col("bad"), "failed").otherwise("success").alias("status")
    outcomes = blocks.select("block_no").join(failed, "block_no", "left").select("block_no", status)
    totals = reconcile(found, outcomes)
    return spark.createDataFrame([tuple(totals[name] for name in ("success", "failed", "not_found"))], "success long, failed long, not_found long")


def _picky(fails: int):
    """Takes a block unless the first id in it, by its digits, is one of those to fail."""

    def send(payload: str) -> None:
        number = sum(map(int, re.findall(r"\d", payload.partition('"id":"')[2].partition('"')[0])))
        if number % fails == 0:
            raise CallFailed(f"HTTP 500: {number}")

    return send


DIGITS_SQL = "list_sum(list_transform(string_split(regexp_replace(ids, ',.*', ''), ''), lambda c: coalesce(try_cast(c as bigint), 0)))"


@query(
    f"""select block_no, n, case when digits % 6 = 0 then 'failed' else 'success' end as status,
    cast(case when digits % 2 <> 0 then 1 when digits % 3 <> 0 then 2 else 3 end as bigint) as n_sent,
    case when digits % 6 = 0 then 'HTTP 500: ' || digits end as error
    from (select block_no, n, {DIGITS_SQL} as digits from ({BLOCKS_SQL}))"""
)
def crm_delivery(spark, sf):
    """Blocks sent in three runs: those that fail are sent again, others are not."""
    blocks = saved(crm.update_blocks(crm.update_records(resolved(spark, sf))), "blocks")
    ledger = new_path(spark, "ledger")
    for fails in (2, 6, 6):
        try:
            deliver(blocks, _picky(fails), ledger, policy=RetryPolicy(max_attempts=1), blocks_per_wave=max(4, blocks.count() // 4))
        except RuntimeError as error:  # the last run takes none of what is left
            if "no block was delivered" not in str(error):
                raise
    return block_outcomes(read_ledger(spark, ledger)).join(blocks.select("block_no", "n"), "block_no")


@query("select cast(o_orderkey as string) as prospect_id, 'a' || cast(o_custkey as string) || '@x.example' as email, o_orderstatus as job_title, '' as company from orders")
def src_contacts_list(spark, sf):
    """One list that holds every contact, read without a cap."""
    orders = base(spark, sf, "orders")
    properties = F.struct(
        F.lit("").alias("hs_object_id"),
        F.concat(F.lit("a"), F.col("o_custkey").cast("string"), F.lit("@x.example")).alias("email"),
        F.col("o_orderstatus").alias("jobtitle"),
        F.lit(None).cast("string").alias("company"),
    )
    contacts = orders.select(F.col("o_orderkey").cast("string").alias("id"), properties.alias("properties"))
    members = orders.select(F.lit("7").alias("list_id"), F.col("o_orderkey").cast("string").alias("contact_id"), F.lit("").alias("record_id"))
    return read_contacts(spark, "list:7", CrmTables(contacts, members))


@query(
    f"""select result, count(*) as n from (
        select case when exists (select 1 from orders where o_orderkey = block_no and o_orderstatus = 'F')
               then 'failed' else 'success' end as result from ({BLOCKED_SQL})
        union all select 'not_found' from ({RESOLVED_SQL}) where contact_id is null) group by result"""
)
def crm_totals(spark, sf):
    status = F.expr("case when o_orderstatus = 'F' then 'failed' else 'success' end").alias("status")
    outcomes = base(spark, sf, "orders").select(F.col("o_orderkey").alias("block_no"), status)
    return crm.import_totals(resolved(spark, sf), outcomes)
