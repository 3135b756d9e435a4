import json

import pytest

from helpers import plan_of, rows
from rolecast.operators import crm
from rolecast.plans.crm_sync import prepare_updates, reconcile
from rolecast.sources import crm as source
from rolecast.sources.contacts import CrmTables, read_contacts

NESTED = [
    ("1", {"hs_object_id": "11", "email": "A@x", "jobtitle": "CTO", "company": None, "firstname": "A", "lastname": None}),
    ("2", {"hs_object_id": None, "email": "b@x", "jobtitle": None, "company": "C", "firstname": None, "lastname": None}),
    ("3", {"hs_object_id": "", "email": None, "jobtitle": "Dev", "company": "C", "firstname": None, "lastname": None}),
    ("40", {"hs_object_id": "40", "email": "a@x", "jobtitle": "Dev", "company": "C", "firstname": None, "lastname": None}),
]


@pytest.fixture(scope="module")
def nested(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("crm") / "contacts.json"
    path.write_text("\n".join(json.dumps({"id": i, "properties": p}) for i, p in NESTED))
    return source.read_crm_contacts(spark, str(path))


@pytest.fixture(scope="module")
def members(spark):
    return spark.createDataFrame(
        [("l1", "11", None), ("l1", "11", None), ("l1", None, "2"), ("l1", "", "99"), ("l2", "40", None), ("l2", "1", None)],
        "list_id string, contact_id string, record_id string",
    )


def test_flatten(nested):
    assert rows(source.flatten_list_contacts(nested)) == [
        ("11", "A@x", "CTO", ""), ("2", "b@x", "", "C"), ("3", "", "Dev", "C"), ("40", "a@x", "Dev", "C")
    ]
    assert rows(source.flatten_report_contacts(nested), "prospect_id") == [("",), ("",), ("11",), ("40",)]


def test_lists_and_reports(spark, nested, members):
    lists = spark.createDataFrame([("7", "l2")], "report_id string, list_id string")
    tables = CrmTables(nested, members, lists)
    assert rows(read_contacts(spark, "list:l1", tables), "prospect_id") == [("11",), ("2",)]
    assert rows(read_contacts(spark, "segment:l1", tables, limit=1), "prospect_id") == [("2",)]
    assert rows(read_contacts(spark, "hubspot:7", tables), "prospect_id") == [("11",), ("40",)]
    assert read_contacts(spark, "8", tables).count() == 4
    with pytest.raises(ValueError, match="no contacts"):
        read_contacts(spark, "list:none", tables)
    with pytest.raises(ValueError, match="id is required"):
        read_contacts(spark, "list:", tables)
    with pytest.raises(ValueError, match="CRM tables"):
        read_contacts(spark, "123")


def test_enum(spark):
    df = spark.createDataFrame([(p,) for p in ("Data User", " data user ", "Real-Time Specialist", "Wizard")], "persona string")
    mapped = crm.with_enum(df)
    assert [r.persona_enum for r in mapped.collect()] == ["persona_5", "persona_5", "persona_6", "Wizard"]
    assert plan_of(mapped).count("BroadcastHashJoin") >= 2
    with pytest.raises(ValueError):
        crm.with_enum(df, {})


ACCEPTED = [
    (0, "5", "q@x", "Data User", "9"), (1, " ", "a@X ", "Data User", None), (2, None, "none@x", "Data User", "1"),
    (3, "", "none@x", "Not a target", "1"), (4, "6", None, "Data User", "1"), (5, " 7 ", "z@x", "wizard", "1"),
]


def accepted(spark):
    return spark.createDataFrame(ACCEPTED, "seq long, prospect_id string, email string, persona string, persona_certainty string")


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0, "hot_rows": 1}])
def test_ids(spark, nested, limits):
    known = source.flatten_list_contacts(nested)
    resolved = crm.resolve_ids(accepted(spark), known, ("seq",), **limits)
    assert rows(resolved, "seq", "contact_id", "id_source") == [
        (0, "5", "own"), (1, "11", "email"), (2, None, "not_found"), (3, None, "not_found"), (5, "7", "own")
    ]
    with pytest.raises(ValueError, match="missing columns"):
        crm.resolve_ids(accepted(spark).drop("email"), known, ("seq",))


def test_sync(spark, nested):
    resolved, blocks = prepare_updates(accepted(spark), source.flatten_list_contacts(nested), size=2)
    sent = {r.block_no: json.loads(r.payload) for r in blocks.collect()}
    assert sent == {
        1: {"inputs": [{"id": "5", "properties": {"hs_persona": "persona_5", "persona_certainty": "9"}},
                       {"id": "11", "properties": {"hs_persona": "persona_5"}}]},
        2: {"inputs": [{"id": "7", "properties": {"hs_persona": "wizard", "persona_certainty": "1"}}]},
    }
    outcomes = spark.createDataFrame([(1, "success"), (2, "failed")], "block_no long, status string")
    assert reconcile(resolved, outcomes, size=2) == {"success": 2, "failed": 1, "not_found": 2}
    nobody = accepted(spark).filter("email is null")
    with pytest.raises(ValueError, match="no contacts"):
        prepare_updates(nobody, source.flatten_list_contacts(nested))
