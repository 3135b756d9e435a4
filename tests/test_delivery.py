"""The delivery ledger: what fails is sent again, what was taken is not."""

import pytest

from helpers import rows
from rolecast.operators.classify import CallFailed, RetryPolicy
from rolecast.sinks.delivery import block_outcomes, deliver, read_ledger

QUIET = RetryPolicy(max_attempts=2, sleep=lambda seconds: None)


def blocks(spark, n=10, changed=()):
    return spark.createDataFrame([(i, 3, f"payload {i}{' new' if i in changed else ''}") for i in range(1, n + 1)], "block_no long, n long, payload string")


def logged(log, bad=()):
    def send(payload):
        with open(log, "a") as file:
            file.write(payload + "\n")
        if any(payload.startswith(f"payload {i}") and payload.split()[1] == str(i) for i in bad):
            raise CallFailed("503") if int(payload.split()[1]) % 2 else KeyError("mistake")

    return send


def sent(log):
    return sorted(open(log).read().splitlines()) if log.exists() else []


def test_only_failed_blocks_are_sent_again(spark, tmp_path):
    ledger, first, second, third = str(tmp_path / "l"), tmp_path / "1", tmp_path / "2", tmp_path / "3"
    told = deliver(blocks(spark), logged(first, bad=(3, 4)), ledger, policy=QUIET, blocks_per_wave=4)
    outcomes = {row.block_no: (row.status, row.n_sent, row.error) for row in block_outcomes(told).collect()}
    assert outcomes[3] == ("failed", 1, "503") and outcomes[4][0] == "failed" and "mistake" in outcomes[4][2] and outcomes[5] == ("success", 1, None)
    assert sent(first).count("payload 3") == 2 and sent(first).count("payload 4") == 1 and len(sent(first)) == 11
    told = deliver(blocks(spark), logged(second), ledger, policy=QUIET)
    assert sent(second) == ["payload 3", "payload 4"] and block_outcomes(told).filter("status = 'success'").count() == 10
    told = deliver(blocks(spark), logged(third), ledger, policy=QUIET)
    assert sent(third) == [] and told.filter("ok").count() == 10
    deliver(blocks(spark, 11, changed=(2,)), logged(third), ledger, policy=QUIET)
    assert sent(third) == ["payload 11", "payload 2 new"]


def test_a_run_that_broke_off_goes_on(spark, tmp_path):
    ledger, log = str(tmp_path / "l"), tmp_path / "log"

    def breaks(payload):
        if payload == "payload 5":
            raise KeyboardInterrupt("stopped")

    with pytest.raises(Exception, match="stopped"):
        deliver(blocks(spark), breaks, ledger, policy=QUIET, blocks_per_wave=2, calls_in_parallel=1)
    assert rows(read_ledger(spark, ledger), "block_no") == [(1,), (2,), (3,), (4,)]
    told = deliver(blocks(spark), logged(log), ledger, policy=QUIET, blocks_per_wave=2)
    assert sent(log) == sorted(f"payload {i}" for i in range(5, 11)) and rows(told, "run") == [(1,)] * 10


def test_a_service_that_takes_nothing_is_an_error(spark, tmp_path):
    ledger, log = str(tmp_path / "l"), tmp_path / "log"
    with pytest.raises(RuntimeError, match="503"):
        deliver(blocks(spark, 1), logged(log, bad=(1,)), ledger, policy=QUIET)
    assert deliver(blocks(spark, 1), logged(log), ledger, policy=QUIET).filter("ok").count() == 1
    assert deliver(blocks(spark, 0), logged(log), str(tmp_path / "none"), policy=QUIET).count() == 0
