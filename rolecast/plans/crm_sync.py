"""Sending accepted personas back to a CRM, up to the calls themselves."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from rolecast import schema as S
from rolecast.operators.clean import require_rows
from rolecast.operators.crm import import_totals, resolve_ids, update_blocks, update_records
from rolecast.session import saved


def prepare_updates(
    accepted: DataFrame,
    crm_contacts: DataFrame,
    mapping: Mapping[str, str] = S.CRM_ENUM,
    size: int = S.CRM_BLOCK,
    order_by: str = "seq",
) -> tuple[DataFrame, DataFrame]:
    """(resolved rows, update blocks). Both are saved tables; the caller delivers the blocks."""
    resolved = saved(resolve_ids(accepted, crm_contacts, (order_by,)), "resolved")
    require_rows(resolved, "no contacts with address and persona to import")
    records = saved(update_records(resolved, mapping).select(order_by, "record"), "records")
    return resolved, saved(update_blocks(records, size, order_by), "blocks")


def reconcile(resolved: DataFrame, outcomes: DataFrame, size: int = S.CRM_BLOCK, order_by: str = "seq") -> dict[str, int]:
    """Totals of an import. A result nobody had counts zero."""
    totals = import_totals(resolved, outcomes, size, order_by).groupBy().pivot(
        "result", ["success", "failed", "not_found"]
    ).agg(F.sum("n"))
    return {name: count or 0 for name, count in totals.first().asDict().items()}
