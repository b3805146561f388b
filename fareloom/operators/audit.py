"""Row-level audit records derived from a merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fareloom.functions.text import row_json
from fareloom.operators.history import MergeResult

AUDIT_COLUMNS = (
    "table_name", "record_id", "operation", "changed_by", "changed_at", "old_values", "new_values",
)


def audit_rows(
    merge: MergeResult, key: str, table: str, changed_by: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One INSERT record per new version and one UPDATE record per version that a later one closed.

    A version that the same batch opens and closes has both. ``record_id`` is the business key. The images are the
    rows as the history held and holds them, the time of the change in ``updated_at`` included. ``columns`` limits
    the JSON to some columns.
    """
    names = list(columns or [c for c in merge.replaced.columns if c != "closed_at"])
    # A version's open and closed state differ in the columns that closing sets, so no join is needed.
    was_open = {"is_current": F.lit(True), "end_date": F.lit(None).cast("timestamp_ntz")}
    closed = dict(merge.closing)

    def updates_of(versions: DataFrame) -> DataFrame:
        return versions.select(
            key,
            F.lit("UPDATE").alias("operation"),
            F.col("closed_at").alias("_at"),
            row_json(names, was_open).alias("_old"),
            row_json(names, closed).alias("_new"),
        )

    superseded = merge.created.filter(F.col("end_date").isNotNull()).withColumn("closed_at", F.col("end_date"))
    updates = updates_of(merge.replaced).unionAll(updates_of(superseded))
    inserts = merge.created.select(
        key,
        F.lit("INSERT").alias("operation"),
        F.col("effective_date").alias("_at"),
        F.lit(None).cast("string").alias("_old"),
        row_json(names, was_open).alias("_new"),
    )
    return updates.unionAll(inserts).select(
        F.lit(table).alias("table_name"),
        F.col(key).cast("string").alias("record_id"),
        "operation",
        F.lit(changed_by).alias("changed_by"),
        F.col("_at").alias("changed_at"),
        F.col("_old").alias("old_values"),
        F.col("_new").alias("new_values"),
    )


def audit_view(log: DataFrame) -> DataFrame:
    """The audit log in its reading order of columns."""
    lead = ["audit_id"] if "audit_id" in log.columns else []
    return log.select(*lead, *AUDIT_COLUMNS)
