"""Quality checks of a stream, counted while its batches are written.

The checks are metrics observed on the way to the sink, so they cost no scan of their own. Each batch
adds its rows to the log of check runs under a run id made of the stream's name and the batch number; a batch that
is repeated after a failure finds its rows there and adds none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from souk.operators.quality import Check, check_log, graded, stamped
from souk.sinks.writers import append
from souk.sources.schemas import DQ_RUN_LOG, EVENT_TYPES
from souk.sources.tables import create_if_absent, read_table
from souk.streaming.triggers import start


def raw_event_checks() -> list[Check]:
    """Ids, types and known types of raw events."""
    n = F.count(F.lit(1))
    return [
        ("no_null_event_ids", n, F.count_if(F.col("event_id").isNull())),
        ("no_null_event_types", n, F.count_if(F.col("event_type").isNull())),
        ("valid_event_types", n, F.count_if(~F.col("event_type").isin(*EVENT_TYPES))),
    ]


def logged_write(
    batch: DataFrame, write: Callable[[DataFrame], None], checks: list[Check], layer: str, table: str, root: str, run_id: str
) -> None:
    """Write a batch and append its check rows unless the log has this run already."""
    spark = batch.sparkSession
    create_if_absent(spark, DQ_RUN_LOG, root)
    counts = Observation()
    metrics = [
        c.alias(f"{side}{i}") for i, (_, checked, failed) in enumerate(checks) for side, c in (("c", checked), ("f", failed))
    ]
    write(batch.observe(counts, *metrics))
    if read_table(spark, DQ_RUN_LOG, root).where(F.col("run_id") == run_id).take(1):
        return
    values = {name: int(value or 0) for name, value in counts.get.items()}
    totals = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    rows = [(name, f"c{i}", f"f{i}", graded(F.col(f"c{i}"), F.col(f"f{i}"))) for i, (name, _, _) in enumerate(checks)]
    append(stamped(check_log(totals, layer, table, rows, run_id)), DQ_RUN_LOG, root)


def run(
    events: DataFrame,
    write: Callable[[DataFrame, int], None],
    root: str,
    checkpoint: str,
    name: str,
    checks: list[Check],
    layer: str = "bronze",
    table: str = "raw_events",
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    """Start a stream whose batches go through ``write`` (which runs one job over all their rows) and into the log."""

    def each(batch: DataFrame, number: int) -> None:
        logged_write(batch, lambda rows: write(rows, number), checks, layer, table, root, f"{name}-{number}")

    return start(events.writeStream.foreachBatch(each), checkpoint, trigger)
