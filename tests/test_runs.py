import json

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from rolecast import schema as S
from rolecast.operators.classify import CallFailed, RetryPolicy, ask_chunks, rule_replies
from rolecast.operators.clean import prepare_contacts
from rolecast.operators.report import open_batches, pass_summary
from rolecast.plans.batch import finish_batch, require_completed, write_requests
from rolecast.plans.manifest import multiset_digest
from rolecast.plans.online import asked_per_pass, parsed_replies, read_replies, run_online, wave_log
from rolecast.plans.rerun import finish_rerun, write_rerun_requests
from rolecast.session import CHECKPOINT_DIR, new_path, shared_dir
from rolecast.sinks.outputs import save_raw, write_decisions
from rolecast.sources.text import read_lines
from rolecast.streaming.nightly import run_nightly

QUIET = RetryPolicy(sleep=lambda seconds: None)


def contacts(spark, n=60):
    return spark.range(n).select(
        F.col("id").cast("string").alias("prospect_id"),
        F.concat(F.lit("u"), "id", F.lit("@x")).alias("email"),
        F.when(F.col("id") % 3 == 0, "CTO").when(F.col("id") % 3 == 1, "Data Analyst").otherwise("Director").alias("job_title"),
    )


def test_online_run_asks_again_and_resumes(spark, tmp_path):
    work = str(tmp_path / "work")

    def choosy(system, payload):
        answer = rule_replies()("", payload)
        lines = answer.split("\n")
        if system != "be nice":
            raise RuntimeError("wrong system text")
        return "```\n" + "\n".join(line for line in lines if len(lines) <= 15 or "CTO" not in line) + "\n```"

    options = {"system": "be nice", "max_chunk": 40, "calls_in_parallel": 2, "policy": QUIET, "chunks_per_wave": 1}
    decided = run_online(contacts(spark), choosy, work, **options)
    assert decided.filter("skip_reason is null").count() == 60
    replies = spark.read.parquet(*[f"{work}/replies/pass-{p}/*" for p in (1, 2, 3)])
    assert sorted({r.pass_no for r in replies.collect()}) == [1, 2, 3]
    assert replies.filter("pass_no = 3").agg(F.sum("n")).first()[0] == 20 - sum(
        r.n for r in replies.filter("pass_no = 2 and n <= 15").collect()
    )

    def must_not_be_called(system, payload):
        raise AssertionError("asked again")

    again = run_online(contacts(spark), must_not_be_called, work, **options)
    assert rows(again) == rows(decided)
    parsed = parsed_replies(replies)
    asked = asked_per_pass(contacts(spark), parsed)
    summary = {r.pass_no: (r.asked, r.processed, r.remaining) for r in pass_summary(asked, parsed.filter(F.col("persona").isin(*S.PERSONAS))).collect()}
    assert summary[1] == (60, 40, 20)


def test_a_stopped_run_keeps_its_finished_waves(spark, tmp_path):
    work = str(tmp_path / "work")

    def breaks(system, payload):
        if "59,Director" in payload:
            raise KeyboardInterrupt("stopped")
        return rule_replies()(system, payload)

    options = {"max_chunk": 20, "calls_in_parallel": 1, "policy": QUIET, "chunks_per_wave": 1}
    with pytest.raises(Exception, match="stopped"):
        run_online(contacts(spark), breaks, work, **options)
    seen = str(tmp_path / "seen")

    def counts(system, payload):
        with open(seen, "a") as log:
            log.write("call\n")
        return rule_replies()(system, payload)

    decided = run_online(contacts(spark), counts, work, **options)
    assert decided.filter("skip_reason is null").count() == 60
    assert open(seen).read() == "call\n"


def test_no_contacts(spark, tmp_path):
    nobody = run_online(contacts(spark, 0), rule_replies(), str(tmp_path / "w"), policy=QUIET)
    assert nobody.count() == 0


def test_failed_calls_leave_contacts_for_the_next_pass(spark, tmp_path):
    def picky(system, payload):
        if payload.count("\n") > 20:
            raise TimeoutError("429 rate_limit_exceeded: try again in 3s")
        return rule_replies()(system, payload)

    decided = run_online(contacts(spark), picky, str(tmp_path / "w"), max_chunk=40, policy=QUIET)
    assert decided.filter("skip_reason is null").count() == 60
    first = spark.read.parquet(str(tmp_path / "w" / "replies" / "pass-1" / "*")).filter("n > 21").first()
    assert (first.reply, first.attempts) == (None, 5) and "429" in first.error and first.wait_seconds >= 2 + 4 + 8 + 16


def test_retry_policy():
    waits = []
    policy = RetryPolicy(sleep=waits.append, jitter=0.0)
    replies = iter([CallFailed("try again in 7.5s"), CallFailed("x"), "fine"])

    def ask(system, payload):
        answer = next(replies)
        if isinstance(answer, Exception):
            raise answer
        return answer

    assert policy.call(ask, "", "") == ("fine", 3, "x", 11.5)
    assert waits == [7.5, 4.0]


def test_mistakes_are_not_retried():
    def wrong(system, payload):
        raise KeyError("persona")

    with pytest.raises(KeyError):
        RetryPolicy(sleep=lambda s: None).call(wrong, "", "")


def test_a_pass_without_a_reply_fails(spark, tmp_path):
    def down(system, payload):
        raise ConnectionError("no route")

    with pytest.raises(RuntimeError, match="no route"):
        run_online(contacts(spark), down, str(tmp_path / "w"), policy=QUIET)


def test_a_work_folder_belongs_to_one_run(spark, tmp_path):
    work = str(tmp_path / "w")
    run_online(contacts(spark, 3), rule_replies(), work, policy=QUIET)
    for changed, options in ((contacts(spark, 10), {}), (contacts(spark, 3), {"max_chunk": 2})):
        with pytest.raises(ValueError, match="another|other contacts"):
            run_online(changed, rule_replies(), work, policy=QUIET, **options)


def titled(spark, *people):
    return spark.createDataFrame(list(people), "prospect_id string, email string, job_title string, seq long")


def test_digests_tell_tables_apart(spark):
    def digest(*rows_):
        return multiset_digest(spark.createDataFrame(list(rows_), "prospect_id string, email string, job_title string").repartition(2))

    one, two, three = ("1", None, "x"), ("2", "", "y"), ("3", None, "z")
    tables = [(one, one, two), (three, three, two), (one, two), (one, one, one, two), (one, one, ("2", None, "y")), (one, one, ("2", "y", "")), ()]
    tables += [(one, one, ("2", "b@x", "y")), ((None, "1", "x"), one, two)]
    assert len({tuple(digest(*rows_)) if rows_ else (0, 0, 0) for rows_ in tables}) == len(tables)
    assert digest(one, two, one) == digest(one, one, two) and multiset_digest(titled(spark, ("1", "a", "b", 1)).limit(0)) == [0, 0, 0]


def test_other_addresses_are_other_contacts(spark, tmp_path):
    work = str(tmp_path / "w")
    run_online(titled(spark, ("1", "a@x", "CTO", 0)), rule_replies(), work, policy=QUIET)
    with pytest.raises(ValueError, match="other contacts"):
        run_online(titled(spark, ("1", "b@x", "CTO", 0)), rule_replies(), work, policy=QUIET)
    grown = run_online(titled(spark, ("1", "b@x", "CTO", 0)), nobody, work, policy=QUIET, grow=True)
    assert rows(grown, "email", "persona") == [("b@x", "Executive Sponsor")]


def nobody(system, payload):
    raise AssertionError(f"asked {payload}")


def heard(log):
    def ask(system, payload):
        with open(log, "a") as file:
            file.write(payload + "\n")
        return rule_replies()(system, payload)

    return ask


def test_a_folder_grows(spark, tmp_path):
    work, log = str(tmp_path / "w"), str(tmp_path / "log")
    first = titled(spark, ("1", "a@x", "CTO", 0), ("2", "b@x", "Director", 1), ("3", "c@x", "Clerk", 2), (None, "n@x", "CIO", 3))
    options = {"policy": QUIET, "grow": True, "keep": ("night",)}
    run_online(first, heard(log), work, **options)
    assert sorted(open(log).read().split()) == ["1,CTO", "2,Director", "3,Clerk"]
    second = titled(spark, ("2", "b@x", "Data Analyst", 0), ("2", "b@x", "CTO", 1), ("4", "d@x", "SRE", 2), ("1", "a@x", "CTO", 3), ("1", "a@x", "CTO", 4))
    decided = run_online(second, heard(log), work, **options)
    assert sorted(open(log).read().split()[3:]) == ["2,Data", "4,SRE", "Analyst"]
    assert rows(decided, "prospect_id", "job_title", "persona", "night") == [
        ("1", "CTO", "Executive Sponsor", 1), ("2", "Data Analyst", "Data User", 2), ("4", "SRE", "Operator/Systems Administrator", 2)
    ]
    assert rows(run_online(second, nobody, work, **options)) == rows(decided)
    back = run_online(first, nobody, work, **options)
    assert rows(back, "prospect_id", "persona", "night") == [
        ("1", "Executive Sponsor", 1), ("2", "Economic Buyer", 1), ("3", "Not a target", 1), (None, None, None)
    ]
    with pytest.raises(ValueError, match="parameters"):
        run_online(second, nobody, work, **options, model="other")


def test_a_night_that_broke_off_is_not_lost(spark, tmp_path):
    work, log = str(tmp_path / "w"), str(tmp_path / "log")

    def breaks(system, payload):
        if payload.startswith("40,"):
            raise KeyboardInterrupt("stopped")
        return rule_replies()(system, payload)

    options = {"policy": QUIET, "grow": True, "max_chunk": 20, "calls_in_parallel": 1, "chunks_per_wave": 1}
    with pytest.raises(Exception, match="stopped"):
        run_online(contacts(spark), breaks, work, **options)
    more = contacts(spark, 61)
    decided = run_online(more, heard(log), work, **options)
    assert decided.filter("skip_reason is null").count() == 61
    assert [line.split(",")[0] for line in open(log).read().splitlines()] == [str(i) for i in range(40, 61)]


def test_waves_shrink_after_a_rate_limit(spark, tmp_path):
    work = str(tmp_path / "w")

    def picky(system, payload):
        if payload.count("\n") >= 12:
            raise CallFailed("429")
        return rule_replies()(system, payload)

    options = {"max_chunk": 40, "policy": QUIET, "chunks_per_wave": 1, "calls_in_parallel": 1}
    decided = run_online(contacts(spark, 100), picky, work, **options)
    assert decided.filter("skip_reason is null").count() == 100
    log = wave_log(read_replies(spark, f"{work}/replies"))
    assert rows(log.filter("pass_no = 1"), "wave", "chunk_size", "n_rows", "rate_limited")[:3] == [(0, 40, 40, 1), (1, 20, 20, 1), (2, 10, 10, 0)]
    assert {row.chunk_size for row in log.filter("pass_no = 2").collect()} == {10}
    assert rows(run_online(contacts(spark, 100), nobody, work, **options)) == rows(decided)


def test_decision_reads_saved_replies(spark, tmp_path):
    decided = run_online(contacts(spark), rule_replies(), str(tmp_path / "w"), threshold=None, policy=QUIET)
    assert "Python" not in plan_of(decided) and "MapInPandas" not in plan_of(decided)


def answered(lines, personas):
    for line in lines:
        request = json.loads(line)
        persona = personas(request["body"]["messages"][1]["content"])
        content = json.dumps({"persona": persona, "certainty": 80})
        body = {"choices": [{"message": {"content": content}}]}
        yield json.dumps({"custom_id": request["custom_id"], "response": {"status_code": 200, "body": body}})


def test_batch_and_rerun(spark, tmp_path):
    people = prepare_contacts(contacts(spark)).withColumn("seq", F.col("prospect_id").cast("long"))
    path = write_requests(people, str(tmp_path / "requests"), " Sort ü. ")
    lines = [r.value for r in spark.read.text(path).collect()]
    first = json.loads(lines[0])
    assert first["body"]["messages"][0]["content"] == "Sort ü." + S.REQUEST_FORMAT
    assert list(first) == ["custom_id", "method", "url", "body"] and first["body"]["temperature"] == 0.0
    assert "ü" in lines[0]
    replies = list(answered(lines, lambda text: "Data Users" if "Analyst" in text else "" if "CTO" in text else "Wizard"))
    output = spark.createDataFrame(list(enumerate(replies)), "line_no long, line string")
    decided = finish_batch(people, output)
    reasons = {r.skip_reason: r.n for r in decided.groupBy("skip_reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {None: 20, "Batch error: No LLM response": 20, "Invalid persona: Wizard": 20}
    skipped = decided.filter("skip_reason is not null")
    again = write_rerun_requests(skipped, str(tmp_path / "again"), "Sort.")
    asked = [r.value for r in spark.read.text(again).collect()]
    assert len(asked) == 20
    results = spark.createDataFrame(list(enumerate(answered(asked, lambda text: "Executive Sponsor"))), "line_no long, line string")
    updated = finish_rerun(skipped, results)
    reasons = {r.skip_reason: r.n for r in updated.groupBy("skip_reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {None: 20, "Invalid persona: Wizard": 20}
    rest = write_requests(people, str(tmp_path / "rest"), "x", answered=decided.filter("skip_reason is null"))
    assert spark.read.text(rest).count() == 40


def test_calls_give_a_saved_table(spark, tmp_path):
    payloads = spark.createDataFrame([(0, 1, "1,x")], "chunk_id long, n long, payload string")
    done = ask_chunks(payloads, rule_replies(), str(tmp_path / "r"), policy=QUIET)
    assert rows(done, "chunk_id", "reply") == [(0, "1,x,Not a target,90")]
    assert "Python" not in plan_of(done)


def test_batch_states(spark, tmp_path):
    jobs = spark.createDataFrame([(1, "completed"), (2, "in_progress"), (3, "failed"), (4, None)], "batch_id int, status string")
    assert rows(open_batches(jobs), "batch_id") == [(2,), (4,)]
    with pytest.raises(ValueError, match="did not complete"):
        require_completed(jobs)
    assert require_completed(jobs.filter("batch_id = 1")).count() == 1
    path = save_raw(jobs.selectExpr("to_json(struct(*)) as line"), str(tmp_path), "batch_1_meta")
    assert "/_checkpoints/batch_1_meta_" in path and read_lines(spark, path).count() == 4


def test_shared_folder(spark, tmp_path):
    configured = spark.conf.get(CHECKPOINT_DIR)
    assert shared_dir(spark) == configured.rstrip("/") and new_path(spark, "x").startswith(configured)
    assert new_path(spark, "x") != new_path(spark, "x")


def test_nights_do_not_ask_twice(spark, tmp_path):
    drop, work, log = tmp_path / "drop", str(tmp_path / "work"), str(tmp_path / "log")
    drop.mkdir()
    (drop / "a.csv").write_text("Record ID,Email,Job Title\n1,a@x,CTO\n2,b@x,Director\n1,a2@x,CTO\n")

    def breaks(system, payload):
        raise KeyboardInterrupt("stopped")

    options = {"policy": QUIET}
    with pytest.raises(Exception, match="stopped"):
        run_nightly(spark, str(drop), work, breaks, **options)
    first = run_nightly(spark, str(drop), work, heard(log), **options)
    assert rows(first, "prospect_id", "email", "persona") == [("1", "a@x", "Executive Sponsor"), ("2", "b@x", "Economic Buyer")]
    (drop / "b.csv").write_text("Job Title,Record ID,Email\nDirector,2,new@x\nClerk,1,a@x\nSRE,3,c@x\n")
    both = run_nightly(spark, str(drop), work, heard(log), **options)
    assert sorted(open(log).read().split()) == ["1,CTO", "1,Clerk", "2,Director", "3,SRE"]
    assert rows(both, "prospect_id", "email", "persona") == [
        ("1", "a@x", "Executive Sponsor"), ("1", "a@x", "Not a target"), ("2", "b@x", "Economic Buyer"), ("2", "new@x", "Economic Buyer"),
        ("3", "c@x", "Operator/Systems Administrator"),
    ]
    assert rows(run_nightly(spark, str(drop), work, nobody, **options)) == rows(both)


def test_a_summary_comes_from_the_write(spark, tmp_path):
    reasons = [None, None, "No LLM response", "Invalid persona: x", "Batch error: HTTP 500: {}", "Batch error: y"]
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def touched(text):
        seen.add(1)
        return text

    decided = spark.createDataFrame([(reason,) for reason in reasons], "given string").select(touched.asNondeterministic()("given").alias("skip_reason"))
    summary = write_decisions(decided, str(tmp_path / "d"))
    assert rows(summary) == [(6, 2, 4, 1, 1, 2)] and seen.value == 6
    assert spark.read.parquet(str(tmp_path / "d")).count() == 6 and seen.value == 6


def test_number_of_waves_does_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    """A run with few chunks a wave has at most so many waves a pass, and asks everyone once."""
    from rolecast.plans import online

    monkeypatch.setattr(online, "WAVES_PER_PASS", 3, raising=False)
    made = [(str(i), f"u{i}@x.example", "Data Analyst", i) for i in range(120)]
    contacts = spark.createDataFrame(made, "prospect_id string, email string, job_title string, seq long")
    decided = online.run_online(contacts, rule_replies(), str(tmp_path), max_chunk=10, chunks_per_wave=1, calls_in_parallel=2, policy=QUIET)
    assert decided.filter("skip_reason is null").count() == 120
    log = online.wave_log(online.read_replies(spark, f"{tmp_path}/replies")).collect()
    assert sorted((row["wave"], row["n_chunks"], row["n_rows"]) for row in log) == [(0, 4, 40), (1, 4, 40), (2, 4, 40)]


def test_a_wave_is_shuffled_once(spark, tmp_path, monkeypatch):
    """Chunks are put together in the tasks that send them."""
    from rolecast.plans import online

    plans = []

    def send(payloads, ask, path, **options):
        plans.append(plan_of(payloads.repartition(options["calls_in_parallel"], "chunk_id")))
        return ask_chunks(payloads, ask, path, **options)

    monkeypatch.setattr(online, "ask_chunks", send)
    made = [(str(i), f"u{i}@x.example", "Data Analyst, EU", i) for i in range(95)]
    contacts = spark.createDataFrame(made, "prospect_id string, email string, job_title string, seq long").repartition(3)
    decided = online.run_online(contacts, rule_replies(), str(tmp_path), max_chunk=10, chunks_per_wave=4, calls_in_parallel=3, policy=QUIET)
    assert decided.filter("skip_reason is null").count() == 95
    assert [plan.count("Exchange") for plan in plans] == [1, 1, 1]
    sent = online.read_replies(spark, f"{tmp_path}/replies").orderBy("chunk_id").collect()
    ids = [line.partition(",")[0] for row in sent for line in row["reply"].split("\n")]
    assert ids == [str(i) for i in range(95)] and [row["n"] for row in sent] == [10] * 9 + [5]
