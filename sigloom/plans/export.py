"""Export job: shape, batch, send; any failed batch fails the job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.sources import export as ex


def export_items(items: DataFrame, processor: str, factory: Callable[[], ex.Sender], results_path: str, force: bool = False,
                 routing: bool = False, limit: int | None = None, tasks: int | None = None, per_round: int = 1000) -> DataFrame:
    """Results are a ledger under ``results_path``: a run after a crash or a failure sends only what it does not hold as sent."""
    ex.require_routing_for_limit(limit, routing)
    shaped = ex.payload(items, processor, force)
    batched = ex.single_records(shaped, limit) if routing else ex.batches(shaped)
    results = ex.send_once(batched, factory, results_path, per_round, tasks=tasks)
    failed = results.agg(F.count_if(~F.col("ok")).alias("n")).first()["n"]
    if failed:
        raise RuntimeError(f"{failed} batches failed")
    return results
