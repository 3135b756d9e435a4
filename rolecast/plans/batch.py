"""The batch run: one request document per contact, answered elsewhere, then read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rolecast import schema as S
from rolecast.operators.clean import require_none
from rolecast.operators.decide import contacts_without, decide
from rolecast.operators.replies import last_results, parse_envelopes, parse_persona_objects
from rolecast.operators.requests import request_documents
from rolecast.session import saved
from rolecast.sinks.outputs import write_lines

LINE_ORDER = ("line_no",)


def write_requests(
    contacts: DataFrame,
    path: str,
    system: str,
    model: str = S.REQUEST_MODEL,
    temperature: float = 0.0,
    answered: DataFrame | None = None,
) -> str:
    """Write the request file. With `answered` (ids that have a result) only the rest is asked."""
    todo = contacts if answered is None else contacts_without(contacts, answered)
    return write_lines(request_documents(todo, system, model, temperature), path, "request")


def batch_results(lines: DataFrame, order: Sequence[str] = LINE_ORDER) -> DataFrame:
    """One row per id of a batch output: its last result, or its last error.

    Lines that tell no id share one more row, with an empty id. They are not filtered out, as
    the filter would be pushed down and parse every line a second time.
    """
    return parse_persona_objects(last_results(parse_envelopes(lines, keep=order), order))


def finish_batch(
    contacts: DataFrame,
    lines: DataFrame,
    order: Sequence[str] = LINE_ORDER,
    taxonomy: Sequence[str] = S.PERSONAS,
    threshold: int | None = S.FUZZY_THRESHOLD,
) -> DataFrame:
    """Decisions from the lines of a finished batch."""
    results = batch_results(lines, order)
    if threshold is not None:
        results = saved(results, "batch-results")
    return decide(contacts, results, order, taxonomy, threshold, batch=True)


def require_completed(jobs: DataFrame) -> DataFrame:
    """Fail unless every batch of a status table `batch_id`, `status` has completed."""
    done = F.coalesce(F.col("status"), F.lit("")) == "completed"
    require_none(jobs.filter(~done), "batches that did not complete")
    return jobs
