"""Queries on filters, clean-up and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.fixtures import VALID, base, fixture
from catalogue.registry import query, sql_list
from rolecast.functions import text as X
from rolecast.operators import clean
from rolecast.operators.classify import rule_persona
from rolecast.operators.report import persona_distribution

MARKER = "@internal"
RULES_SQL = """case when regexp_matches(job_title, 'Founder|Owner|Chief|President|Officer|CEO|CTO|CIO') then 'Executive Sponsor'
    when regexp_matches(job_title, 'Product Manager|Product Owner') then 'Data Product Manager/Owner'
    when regexp_matches(job_title, 'VP|Director|Head') then 'Economic Buyer'
    when regexp_matches(job_title, 'Architect|Principal') then 'Technical Decision Maker'
    when regexp_matches(job_title, 'Administrator|Operator|SRE|Reliability') then 'Operator/Systems Administrator'
    when regexp_matches(job_title, 'Real-time|Streaming') then 'Real-time Specialist'
    when regexp_matches(job_title, 'Analyst|Scientist') then 'Data User'
    when regexp_matches(job_title, 'Engineer|Developer') then 'Application Developer'
    else 'Not a target' end"""


@query("select * from prospects where not contains(email, '@internal')")
def flt_internal_domain(spark, sf):
    return clean.drop_internal(fixture(spark, sf, "prospects"), MARKER)


@query("select * from prospects where not regexp_matches(email, '@internal|test')")
def flt_test_pattern(spark, sf):
    return clean.drop_matching(fixture(spark, sf, "prospects"), f"{MARKER}|test")


@query("select * from prospects where trim(job_title) <> ''")
def flt_nonblank_title(spark, sf):
    return clean.keep_titled(fixture(spark, sf, "prospects"))


@query("select * from prospects_raw where job_title is not null")
def flt_notnull_title(spark, sf):
    return clean.keep_title_not_null(fixture(spark, sf, "prospects_raw"))


@query("select prospect_id, email, job_title, seq from prospects")
def prj_three_cols(spark, sf):
    contacts = fixture(spark, sf, "prospects").withColumn("company", F.lit("x"))
    return clean.project_contacts(contacts)


@query(f"select * from replies where persona in ({sql_list(VALID)})")
def flt_valid_persona(spark, sf):
    return clean.keep_valid_persona(fixture(spark, sf, "replies"))


@query("select * from skipped where trim(coalesce(persona, '')) = ''")
def flt_rerun_mask(spark, sf):
    return clean.keep_without_persona(fixture(spark, sf, "skipped"))


@query("select * from accepted_rows where email is not null and persona is not null")
def flt_importable(spark, sf):
    return clean.keep_importable(fixture(spark, sf, "accepted_rows"))


@query(
    "select "
    + ", ".join(
        f"case when {c} in ('nan', 'NaN', 'None') then '' else coalesce({c}, '') end as {c}"
        for c in ("email", "job_title", "first_name", "last_name", "company")
    )
    + ", record_id from prospects_raw"
)
def cln_null_tokens(spark, sf):
    return clean.clean_null_tokens(fixture(spark, sf, "prospects_raw"))


@query("select record_id as prospect_id, email, job_title, first_name, last_name, company from prospects_raw")
def cln_rename(spark, sf):
    return clean.rename_id(fixture(spark, sf, "prospects_raw"))


@query(
    "select cast(doc_id as string) as prospect_id, replace(text, ',', ' ') as job_title from documents "
    "union all select prospect_id, replace(job_title, ',', ' ') from prospects"
)
def fn_sanitize(spark, sf):
    long_titles = base(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("prospect_id"), F.col("text").alias("job_title")
    )
    titles = long_titles.unionByName(fixture(spark, sf, "prospects").select("prospect_id", "job_title"))
    return titles.withColumn("job_title", X.sanitize_title(F.col("job_title")))


@query(f"select prospect_id, job_title, {RULES_SQL} as persona from prospects")
def cls_rules(spark, sf):
    contacts = fixture(spark, sf, "prospects").select("prospect_id", "job_title")
    return contacts.withColumn("persona", rule_persona(F.col("job_title")))


@query(
    f"""select persona, count(*) as n, round(100.0 * count(*)::double / sum(count(*)) over ()::double, 6) as percent
    from (select {RULES_SQL} as persona from prospects
          where not contains(email, '@internal') and trim(job_title) <> '') group by persona"""
)
def persona_share(spark, sf):
    """Share of each persona among contacts that pass the filters, by the rule table."""
    contacts = clean.prepare_contacts(fixture(spark, sf, "prospects"), MARKER)
    return persona_distribution(contacts.withColumn("persona", rule_persona(F.col("job_title"))))
