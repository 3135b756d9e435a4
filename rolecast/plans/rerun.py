"""Asking again for contacts an earlier run skipped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rolecast import schema as S
from rolecast.operators.clean import keep_without_persona
from rolecast.operators.decide import update_skipped
from rolecast.plans.batch import LINE_ORDER, batch_results, write_requests
from rolecast.session import saved


def write_rerun_requests(skipped: DataFrame, path: str, system: str, model: str = S.REQUEST_MODEL) -> str:
    """Requests for the skipped contacts that still have no persona."""
    return write_requests(keep_without_persona(skipped), path, system, model)


def finish_rerun(
    skipped: DataFrame,
    lines: DataFrame,
    order: Sequence[str] = LINE_ORDER,
    taxonomy: Sequence[str] = S.PERSONAS,
) -> DataFrame:
    """All skipped rows with their new values and reasons. Nothing is repaired here."""
    return update_skipped(skipped, saved(batch_results(lines, order), "rerun-results"), taxonomy)
