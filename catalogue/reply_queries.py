"""Queries on parsing replies and repairing personas."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.fixtures import REPAIRED, VALID, base, fixture
from catalogue.registry import query, sql_list, sql_pairs
from rolecast.operators import repair, replies
from rolecast.plans.batch import batch_results
from rolecast.session import new_path, saved
from rolecast.sinks.outputs import write_lines
from rolecast.sources.text import read_lines

TIDY_SQL = """select prospect_id, n,
    case when trim(persona) not in ('', 'nan', 'NaN', 'None', 'NA', 'null') then trim(persona) end as persona,
    persona_certainty from replies"""
LINES_SQL = r"""select chunk_id, part_no, unnest(string_split_regex(reply, '\r?\n')) as line,
    cast(generate_subscripts(string_split_regex(reply, '\r?\n'), 1) - 1 as int) as line_no
    from chunk_replies where trim(reply) <> ''"""
CELLS_SQL = f"""select chunk_id, part_no, line_no,
    string_split(replace(line, '"VP, Sales"', 'VP' || chr(1) || ' Sales'), ',') as c
    from ({LINES_SQL}) where trim(line) <> ''"""
ENVELOPE_SQL = """select line_no, line,
    coalesce(case when json_valid(line) then json_extract_string(line, '$.custom_id') end, '') as prospect_id,
    case when json_valid(line) and json_extract_string(line, '$.response.status_code') = '200'
         then json_extract_string(line, '$.response.body.choices[0].message.content') end as content,
    case when not json_valid(line) then 'Invalid JSON: ' || line
         when json_extract_string(line, '$.response.status_code') = '200' then
              case when json_extract_string(line, '$.response.body.choices[0].message.content') is null
                   then 'Malformed success body: ' || coalesce(cast(json_extract(line, '$.response.body') as string), '{}') end
         else 'HTTP ' || coalesce(json_extract_string(line, '$.response.status_code'), '0') || ': '
              || coalesce(json_extract_string(line, '$.response.body.error.message'),
                          cast(json_extract(line, '$.response.body') as string), '{}') end as error
    from batch_output"""
_TIDY = "nullif(trim({0}), '') not in ('nan', 'NaN', 'None', 'NA', 'null')"
OBJECT_SQL = """select * exclude (content, error),
    case when good then nullif(trim(json_extract_string(content, '$.persona')), '') end as raw_persona,
    case when good then nullif(trim(json_extract_string(content, '$.certainty')), '') end as persona_certainty,
    coalesce(error, case when content is not null and not good then 'Invalid JSON: ' || content end) as error
    from (select *, coalesce(json_valid(content) and content[1] = '{', false) as good from ({0}))"""
RESULT_COLUMNS = """prospect_id,
    case when raw_persona not in ('nan', 'NaN', 'None', 'NA', 'null') then raw_persona end as persona,
    persona_certainty, error"""
LAST_SQL = f"""select * from ({ENVELOPE_SQL}) 
    qualify row_number() over (partition by prospect_id order by (content is not null) desc, line_no desc, line desc) = 1"""


@query("select * from chunk_replies where trim(reply) <> ''")
def rep_nonempty(spark, sf):
    return replies.keep_nonempty(fixture(spark, sf, "chunk_replies"))


@query(
    f"""select chunk_id, part_no, line_no, c[1] as prospect_id, replace(c[2], chr(1), ',') as job_title,
    nullif(c[3], '') as persona, nullif(c[4], '') as persona_certainty,
    case when len(c) = 4 then 'ok' when len(c) > 4 then 'long' else 'short' end as shape from ({CELLS_SQL})"""
)
def rep_csv(spark, sf):
    asked = replies.keep_nonempty(fixture(spark, sf, "chunk_replies"))
    return replies.parse_reply_lines(asked, keep=("chunk_id", "part_no"))


@query(
    f"""select case when len(c) = 4 then 'ok' when len(c) > 4 then 'long' else 'short' end as shape, count(*) as n
    from ({CELLS_SQL}) group by 1"""
)
def rep_shape(spark, sf):
    return replies.line_shapes(replies.parse_reply_lines(fixture(spark, sf, "chunk_replies")))


@query(
    """select prospect_id, n, persona, persona_certainty from replies
    qualify row_number() over (partition by prospect_id order by n, persona, persona_certainty) = 1"""
)
def rep_first(spark, sf):
    return replies.first_per_id(fixture(spark, sf, "replies"), ["n", "persona", "persona_certainty"])


@query(f"select prospect_id, line_no, line, content, error from ({LAST_SQL})")
def rep_last(spark, sf):
    envelopes = replies.parse_envelopes(fixture(spark, sf, "batch_output"), keep=("line_no", "line"))
    return replies.last_results(envelopes, ["line_no", "line"])


@query(f"select line_no, prospect_id, content, error from ({ENVELOPE_SQL})")
def rep_envelope(spark, sf):
    return replies.parse_envelopes(fixture(spark, sf, "batch_output"), keep=("line_no",))


@query(f"select line_no, {RESULT_COLUMNS} from ({OBJECT_SQL.replace('{0}', ENVELOPE_SQL)})")
def rep_persona(spark, sf):
    envelopes = replies.parse_envelopes(fixture(spark, sf, "batch_output"), keep=("line_no",))
    return replies.parse_persona_objects(envelopes)


@query(f"select {RESULT_COLUMNS} from ({OBJECT_SQL.replace('{0}', LAST_SQL)})")
def rep_batch_results(spark, sf):
    return batch_results(fixture(spark, sf, "batch_output"), ("line_no", "line")).drop("line_no", "line")


@query(
    f"""select prospect_id, n, t.persona, persona_certainty, g.name as repaired
    from ({TIDY_SQL}) t left join (values {sql_pairs(REPAIRED)}) as g(word, name) on t.persona = g.word"""
)
def fix_fuzzy(spark, sf):
    tidy = replies.tidy_replies(fixture(spark, sf, "replies"))
    return repair.with_repairs(tidy, ["prospect_id", "n", "persona_certainty"])


@query(
    f"""with scored as (
        select w.persona as word, t.name,
               1 - levenshtein(w.persona, t.name)::double / greatest(length(w.persona), length(t.name)) as score
        from (select distinct trim(persona) as persona from replies) w, (select unnest([{sql_list(VALID)}]) as name) t
        where w.persona <> '' and w.persona not in ({sql_list(VALID)})),
    best as (select word, name from scored where score >= 0.6
             qualify row_number() over (partition by word order by score desc, name desc) = 1)
    select prospect_id, n, t.persona, persona_certainty, best.name as repaired
    from ({TIDY_SQL}) t left join best on t.persona = best.word"""
)
def fix_levenshtein(spark, sf):
    tidy = replies.tidy_replies(fixture(spark, sf, "replies"))
    return repair.with_repairs(tidy, ["prospect_id", "n", "persona_certainty"], by_edits=True)


@query(
    f"""select prospect_id, n, t.persona, persona_certainty, g.name as repaired
    from ({TIDY_SQL}) t left join (values {sql_pairs(REPAIRED)}) as g(word, name) on t.persona = g.word"""
)
def fix_fuzzy_salted(spark, sf):
    """As `fix_fuzzy` with frequent words spread over tasks."""
    tidy = replies.tidy_replies(fixture(spark, sf, "replies"))
    return repair.with_repairs(tidy, ["prospect_id", "n", "persona_certainty"], max_rows=0, hot_rows=100)


TEXTS_SQL = """select p_name as persona from part union all select unnest(string_split_regex(text, '[ \n]+')) from documents
    union all select persona from replies"""


# The score of a pair, as the library has it: the longest run of letters that both texts have,
# the first of equally long ones, then the same on both sides of it; twice the letters found
# over both lengths. The larger of equally close names wins.
RUN_SQL = """coalesce(list_position(list_transform(range(least(ahi - i, bhi - j)), lambda x: name[i + x + 1] <> word[j + x + 1]), true) - 1,
    least(ahi - i, bhi - j))"""
CLOSEST_SQL = f"""with recursive words as (select distinct trim(persona) as word from ({TEXTS_SQL})),
    names as (select unnest([{sql_list(VALID)}]) as name),
    lengths as (
        select word, name from words, names where word <> '' and word not in (select name from names)
        and 200 * least(length(word), length(name)) >= 60 * (length(word) + length(name))),
    letters_of_word as (select word, c, count(*) as n from (select word, unnest(string_split(word, '')) as c from (select distinct word from lengths)) group by 1, 2),
    letters_of_name as (select name, c, count(*) as n from (select name, unnest(string_split(name, '')) as c from names) group by 1, 2),
    near as (
        select l.word, l.name from lengths l join letters_of_word w on l.word = w.word join letters_of_name m on l.name = m.name and w.c = m.c
        group by 1, 2 having 200 * sum(least(w.n, m.n)) >= 60 * (length(l.word) + length(l.name))),
    steps(word, name, alo, ahi, blo, bhi, found) as (
        select word, name, 0::bigint, length(name), 0::bigint, length(word), 0::bigint from near
        union all
        select word, name, side.alo, side.ahi, side.blo, side.bhi, side.found from (
            select word, name, unnest([
                {{'alo': alo, 'ahi': i, 'blo': blo, 'bhi': j, 'found': k}}, {{'alo': i + k, 'ahi': ahi, 'blo': j + k, 'bhi': bhi, 'found': 0::bigint}}]) as side
            from (select *, best // 1000000 as k, 999 - best // 1000 % 1000 as i, 999 - best % 1000 as j from (
                select *, list_max(flatten(list_transform(range(alo, ahi), lambda i: list_transform(range(blo, bhi), lambda j:
                    {RUN_SQL} * 1000000 + (999 - i) * 1000 + 999 - j)))) as best
                from steps where alo < ahi and blo < bhi)) where k > 0)),
    scored as (select word, name, 2.0::double * sum(found)::double / (length(word) + length(name))::double as score from steps group by 1, 2)
    select word, name as repaired from scored where score >= 0.6::double
    qualify row_number() over (partition by word order by score desc, name desc) = 1"""


@query(CLOSEST_SQL)
def fix_fuzzy_texts(spark, sf):
    """Repairs of many distinct texts, few of which are near a name."""
    words = base(spark, sf, "documents").select(F.explode(F.split("text", "[ \n]+")).alias("persona"))
    texts = base(spark, sf, "part").select(F.col("p_name").alias("persona")).unionByName(words)
    texts = texts.unionByName(fixture(spark, sf, "replies").select("persona"))
    given = texts.select(F.trim("persona").alias("persona")).filter("persona <> ''")
    return repair.repair_table(saved(repair.invalid_words(given), "words"))


@query(
    f"""select prospect_id, content, error from (select * from ({ENVELOPE_SQL})
    qualify row_number() over (partition by prospect_id order by (content is not null) desc, line_no desc, line desc) = 1)
    where prospect_id <> ''"""
)
def rep_last_files(spark, sf):
    """Output in folders of very different sizes, several files each: the later file wins,
    however Spark packs them."""
    part, padding = F.lpad(F.col("line_no").cast("string"), 4, "0"), F.expr("repeat(' ', line_no % 3 * 200)")
    lines = fixture(spark, sf, "batch_output").select("line", "line_no", part.alias("part"))
    ordered = lines.repartitionByRange("part", "line").sortWithinPartitions("part", "line")
    path = new_path(spark, "outputs")  # padded after the shuffle, and packed: more than half is padding
    ordered.select(F.concat("line", padding).alias("value"), "part").write.partitionBy("part").text(path, compression="gzip")
    envelopes = replies.parse_envelopes(read_lines(spark, path), keep=("line_no",))
    return replies.last_results(envelopes, ["line_no"]).select("prospect_id", "content", "error").filter("prospect_id <> ''")


@query(
    """select l_orderkey as chunk_id, cast(l_linenumber as int) as part_no, cast(l_orderkey as varchar) as prospect_id,
    md5('VP' || repeat(', VP', cast(1000 + l_quantity as int))) as title_digest, 'Data User' as persona, '9' as persona_certainty,
    case l_returnflag when 'R' then 'long' else 'ok' end as shape from lineitem"""
)
def rep_wide(spark, sf):
    """Replies whose quoted titles hold more than a thousand commas, some with a fifth cell."""
    lines = base(spark, sf, "lineitem")
    title = F.expr("concat('\"VP', repeat(', VP', cast(1000 + l_quantity as int)), '\"')")
    cells = [F.col("l_orderkey").cast("string"), title, F.lit("Data User"), F.lit("9")]
    reply = F.concat(F.concat_ws(",", *cells), F.when(F.col("l_returnflag") == "R", ",note, more").otherwise(""))
    asked = lines.select(F.col("l_orderkey").alias("chunk_id"), F.col("l_linenumber").cast("int").alias("part_no"), reply.alias("reply"))
    parsed = replies.parse_reply_lines(asked, keep=("chunk_id", "part_no"))
    return parsed.withColumn("title_digest", F.md5("job_title")).drop("line_no", "job_title")
