"""Contact-like tables derived from the given ones, in SQL that Spark and DuckDB both run.

Every table takes in all rows of its source. Gaps, repeats and odd values come from the data
themselves, not from dropping rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Near misses of a persona name by tax rate, and what they stand for.
NEAR = (
    "Exec Sponsor",
    "Economic buyer",
    "Data Product Manager",
    "Data Users",
    "Developer",
    "Real-Time Specialist",
    "System Administrator",
    "Technical User",
    "Not a Target",
)
REPAIRED = {
    "Exec Sponsor": "Executive Sponsor",
    "Economic buyer": "Economic Buyer",
    "Data Product Manager": "Data Product Manager/Owner",
    "Data Users": "Data User",
    "Developer": "Application Developer",
    "Real-Time Specialist": "Real-time Specialist",
    "System Administrator": "Operator/Systems Administrator",
    "Technical User": "Technical Decision Maker",
    "Not a Target": "Not a target",
}
JUNK = (
    " Executive Sponsor ",
    "Wizard",
    "IT Manager",
    "NOT A TARGET",
    "Architect",
    "nan",
    "",
    "Business Beneficiary",
    "Student",
)
VALID = (
    "Executive Sponsor",
    "Economic Buyer",
    "Data Product Manager/Owner",
    "Data User",
    "Application Developer",
    "Real-time Specialist",
    "Operator/Systems Administrator",
    "Technical Decision Maker",
    "Not a target",
)
TITLES = (
    "Chief Technology Officer",
    "VP, Engineering",
    "Software Engineer",
    "Data Analyst",
    "",
    "Director, Finance",
    "Student",
    "  ",
    "Platform Architect",
    "Senior Product Manager, Data",
    "Ingénieur réseau (SRE)",
    "Founder & CEO",
)


def _pick(index: str, values: tuple[str, ...], start: int = 0) -> str:
    return f"split_part('{'|'.join(values)}', '|', {index} + {1 - start})"


_TAX = "cast(round(l_tax * 100) as int)"
_MONTH = "cast(extract(month from o_orderdate) as int)"
_DOMAIN = (
    "case o_orderpriority when '1-URGENT' then 'internal.example' when '2-HIGH' then 'machinery.example' "
    "when '3-MEDIUM' then 'contest.example' when '4-NOT SPECIFIED' then 'building.example' else 'household.example' end"
)
_PERSONA = (
    f"case l_returnflag when 'A' then {_pick(_TAX, VALID)} when 'N' then {_pick(_TAX, NEAR)} "
    f"else {_pick(_TAX, JUNK)} end"
)
_QUOTE = "chr(92) || '\"'"


def _content(inner: str) -> str:
    """A reply text inside an envelope; `~` in `inner` is a quote escaped once."""
    parts = inner.split("~")
    return f" || {_QUOTE} || ".join(f"'{p}'" for p in parts)


_OPEN = "'{\"custom_id\":\"' || cast(l_orderkey as string) || '\",\"response\":'"
_GOOD_HEAD = f"{_OPEN} || '{{\"status_code\":200,\"body\":{{\"choices\":[{{\"message\":{{\"content\":\"' || "
_GOOD_TAIL = " || '\"}}]}}}'"
_CERTAINTY = "cast(cast(l_quantity as int) as string)"

FIXTURES = {
    # One contact per order.
    "prospects": f"""
        select cast(o_orderkey as string) as prospect_id, o_orderkey as seq,
               'user' || cast(o_custkey as string) || '@' || {_DOMAIN} as email,
               {_pick(_MONTH, TITLES, 1)} as job_title
        from orders""",
    # The same, some without an id.
    "nameless": f"""
        select case o_orderpriority when '5-LOW' then '' when '1-URGENT' then ' ' else cast(o_orderkey as string) end as prospect_id,
               o_orderkey as seq, 'user' || cast(o_custkey as string) || '@' || {_DOMAIN} as email,
               {_pick(_MONTH, TITLES, 1)} as job_title
        from orders""",
    # The same as an export with missing-value words and nulls.
    "prospects_raw": f"""
        select cast(o_orderkey as string) as record_id,
               case o_orderstatus when 'F' then 'nan' else 'user' || cast(o_custkey as string) || '@raw.example' end as email,
               nullif({_pick(_MONTH, TITLES, 1)}, 'Student') as job_title,
               case o_orderpriority when '1-URGENT' then 'NaN' when '2-HIGH' then 'Nan' else 'Ann' end as first_name,
               case o_orderpriority when '1-URGENT' then 'None' when '5-LOW' then nullif('a', 'a') else 'None at all' end as last_name,
               case o_orderstatus when 'P' then ' nan ' else 'Company ' || cast(o_custkey as string) end as company
        from orders""",
    # Replies in the order of n; an order has none, one or several.
    "replies": f"""
        select cast(l_orderkey as string) as prospect_id, cast(l_linenumber as int) as n, {_PERSONA} as persona,
               {_CERTAINTY} || case l_linestatus when 'F' then '%' else '' end as persona_certainty
        from lineitem""",
    # A reply text per line item: fence, data line, blank line, short line, blanks, fence.
    "chunk_replies": f"""
        select l_orderkey as chunk_id, cast(l_linenumber as int) as part_no,
               case when l_tax = 0.08 and l_returnflag = 'R' then case l_linestatus when 'F' then '' else '  ' end else
               '```csv' || chr(10) || cast(l_orderkey as string) || ',' ||
               case l_linestatus when 'F' then '"VP, Sales"' else 'Engineer' end || ',' || {_PERSONA} || ',' ||
               {_CERTAINTY} || case l_returnflag when 'R' then ',note' else '' end || chr(13) || chr(10) ||
               chr(10) || cast(l_partkey as string) || ',Clerk' || chr(10) || '   ' || chr(10) || '```' end as reply
        from lineitem""",
    # One output line per line item, of eleven kinds by discount.
    "batch_output": f"""
        select cast(l_linenumber as int) as line_no,
          case cast(round(l_discount * 100) as int)
            when 0 then {_OPEN} || '{{"status_code":429,"body":{{"error":{{"message":"slow down"}}}}}}}}'
            when 1 then {_OPEN} || '{{"status_code":500}}}}'
            when 2 then {_OPEN} || '{{"status_code":200,"body":{{}}}}}}'
            when 3 then 'upstream closed the connection ' || cast(l_orderkey as string) || repeat(' and again', 30)
            when 4 then {_GOOD_HEAD} {_content("```json {~persona~: ~Data User~}")} {_GOOD_TAIL}
            when 5 then {_GOOD_HEAD} {_content("{~persona~: null, ~certainty~: 10}")} {_GOOD_TAIL}
            when 6 then {_GOOD_HEAD} {_content("{~persona~: ~ Data User ~, ~certainty~: ~90%~}")} {_GOOD_TAIL}
            when 7 then {_OPEN} || 'null}}'
            when 8 then {_GOOD_HEAD} {_content("[1, 2]")} {_GOOD_TAIL}
            else {_GOOD_HEAD} {_content("{~persona~: ~")} || {_PERSONA} ||
                 {_content("~, ~certainty~: ")} || {_CERTAINTY} || '}}' {_GOOD_TAIL}
          end as line
        from lineitem""",
    # Contacts an earlier run skipped, with long titles, and new values for some of them.
    "skipped": """
        select cast(doc_id as string) as prospect_id, source || '@skip.example' as email, text as job_title,
               case lang when 'en' then '' when 'de' then nullif('a', 'a') when 'fr' then 'Wizard' else '   ' end as persona,
               case lang when 'en' then '' when 'fr' then '40' else nullif('a', 'a') end as persona_certainty,
               case lang when 'fr' then 'Invalid persona: Wizard' else 'Batch error: HTTP 500: {}' end as skip_reason
        from documents""",
    "rerun_results": """
        select cast(doc_id as string) as prospect_id,
               case when quality = 1 and toxic = 0 then 'Data User' when quality = 1 then 'Economic buyer'
                    when toxic = 1 then '  ' else nullif('a', 'a') end as persona,
               case when quality = 1 then '88' else '' end as persona_certainty,
               case when quality = 1 then nullif('a', 'a') else 'HTTP 429: slow down' end as error
        from labels""",
    "crm_flat": """
        select cast(c_custkey as string) as id,
               case c_mktsegment when 'AUTOMOBILE' then nullif('a', 'a') when 'FURNITURE' then ''
                    else cast(c_custkey as string) end as hs_object_id,
               case when c_acctbal < 0 then nullif('a', 'a')
                    else 'User' || cast(c_custkey as string) || '@' || c_mktsegment || '.example' end as email,
               case c_mktsegment when 'BUILDING' then nullif('a', 'a') else 'Buyer' end as jobtitle,
               c_name as firstname, nullif(c_mktsegment, 'MACHINERY') as lastname, c_mktsegment as company
        from customer""",
    "memberships": """
        select o_orderpriority as list_id,
               case o_orderstatus when 'P' then nullif('a', 'a') when 'F' then '' else cast(o_custkey as string) end as contact_id,
               case o_orderstatus when 'O' then nullif('a', 'a') else cast(o_custkey as string) end as record_id
        from orders""",
    # Accepted contacts, some without an id of their own, some without address or certainty.
    "accepted_rows": f"""
        select o_orderkey as seq,
               case o_orderstatus when 'P' then '' when 'F' then ' ' || cast(o_orderkey as string) || ' '
                    else cast(o_orderkey as string) end as prospect_id,
               nullif('user' || cast(o_custkey as string) || '@' || {_DOMAIN},
                      'user' || cast(o_custkey as string) || '@internal.example') as email,
               {_pick(_MONTH, VALID + ("real-time specialist", "Real-Time Specialist", " Wizard "), 1)} as persona,
               case o_orderpriority when '2-HIGH' then nullif('a', 'a') when '3-MEDIUM' then '90%' else '75' end as persona_certainty
        from orders""",
    # Calls and what went wrong with them.
    "attempts": """
        select event_id, cast(user_id as int) + 1 as chunk_size,
               case event_type when 'view' then 0 when 'click' then 1 when 'signup' then 2 when 'purchase' then 3 else 4 end as attempt,
               case event_type
                 when 'error' then '429 rate_limit_exceeded: try again in ' || cast(cast(floor(value) as int) as string) || 's | busy'
                 when 'view' then 'HTTP 500: try later'
                 when 'click' then 'request timeout: try again in 12.5s'
                 when 'signup' then 'Rate limit reached, try again in ' || cast(cast(floor(value) as int) as string) || '.25s'
                 else 'HTTP 400: props ' || props end as error
        from events""",
    "request_log": """
        select user_id as batch_id, ts as logged_at,
               case event_type when 'purchase' then 'completed' when 'error' then 'failed' else 'open' end as outcome
        from events""",
    # Status of batches, as a vendor reports it.
    "batch_jobs": """
        select event_id as batch_id,
               case event_type when 'view' then 'in_progress' when 'click' then 'completed' when 'signup' then 'failed'
                    when 'purchase' then 'cancelled' else nullif('a', 'a') end as status,
               cast(floor(value) as bigint) as completed, user_id as failed,
               case event_type when 'view' then 0 when 'click' then nullif(1, 1) else cast(floor(value * 2) as bigint) end as given_total,
               case event_type when 'signup' then nullif(1, 1) else event_id end as started_at
        from events""",
    "run_log": """
        select case l_returnflag when 'A' then 200 when 'N' then 300 else 500 end as chunk_size,
               case when l_discount > l_tax then 1 else 0 end as skipped
        from lineitem""",
    "sheets": """
        select 'Customers' as sheet, cast(c_custkey as string) as prospect_id, c_name as first_name,
               c_mktsegment as company from customer
        union all
        select 'Suppliers', cast(s_suppkey as string), s_name, nullif('a', 'a') from supplier
        union all
        select 'HubSpot Export Summary', cast(n_nationkey as string), n_name, 'summary' from nation""",
    # Replies of several passes.
    "pass_replies": f"""
        select cast(l_linenumber as int) as pass_no, cast(l_orderkey as string) as prospect_id, {_PERSONA} as persona
        from lineitem""",
}


def _needed(sql: str) -> list[str]:
    """Fixtures a statement names, those it needs first."""
    order: list[str] = []
    for name in FIXTURES:
        if re.search(rf"\b{name}\b", sql):
            order.append(name)
    return order


def with_fixtures(sql: str) -> str:
    """An oracle statement with the fixtures it names in front."""
    ctes = ", ".join(f"{name} as ({FIXTURES[name]})" for name in _needed(sql))
    return f"with {ctes} select * from ({sql}) as oracle_rows" if ctes else sql


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. One of fewer read tasks than cores, such as a single file with a single
    row group, is dealt out to the cores as it is read."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = FIXTURES[name]
    for table in BASE:
        if re.search(rf"\bfrom {table}\b", sql):
            base(spark, sf_dir, table).createOrReplaceTempView(f"given_{table}")
            sql = re.sub(rf"\bfrom {table}\b", f"from given_{table}", sql)
    return spark.sql(sql)
