"""Publish only when the quality score passes; otherwise quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack import domain
from tidewrack.operators import quality
from tidewrack.plans import medallion
from tidewrack.sources import lake as store
from tidewrack.sources.commits import PUBLISHED, QUARANTINED
from tidewrack.sources.lake import Lake


def decide(report: DataFrame, gate: float = domain.PUBLISH_GATE_SCORE) -> DataFrame:
    """The report with PUBLISH or QUARANTINE, and whether the score deserves a warning."""
    return report.withColumns(
        {
            "decision": F.when(F.col("score") >= gate, F.lit("PUBLISH")).otherwise(
                F.lit("QUARANTINE")
            ),
            "warning": F.col("score") < domain.WARN_SCORE,
        }
    )


def gated_publish(
    spark: SparkSession, lake: Lake, dataset: str, events: DataFrame, batch_id: str,
    gate: float = domain.PUBLISH_GATE_SCORE,
) -> str:
    """Score a batch that silver holds, then publish it to gold, or quarantine it and store its defective rows.

    One report row reaches the driver. A failure while publishing also quarantines the defective rows,
    and is raised again. A quarantined batch leaves silver and gold, also if it was published before.
    """
    report = decide(quality.quality_report(events, dataset), gate)
    store.write_report(report, lake, dataset)
    decision = spark.read.schema(report.schema).json(lake.report_path(dataset)).first()["decision"]
    if decision == "PUBLISH":
        try:
            medallion.set_state(spark, lake, dataset, batch_id, PUBLISHED)
            medallion.publish_gold(spark, lake, dataset)
        except Exception:
            _quarantine(events, lake, dataset, batch_id)
            raise
    else:
        _quarantine(events, lake, dataset, batch_id)
        if batch_id in lake.log(spark, "silver", dataset).live():
            medallion.set_state(spark, lake, dataset, batch_id, QUARANTINED)
            medallion.publish_gold(spark, lake, dataset)
    return decision


def _quarantine(events: DataFrame, lake: Lake, dataset: str, batch_id: str) -> None:
    store.write_batch(
        quality.rejected_rows(events, dataset),
        lake, "quarantine", dataset, "arrived_at", batch_id,
    )
