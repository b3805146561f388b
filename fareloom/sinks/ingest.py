"""Config-driven ingestion: read, validate, clean, land, upsert; one source at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from fareloom.operators.contract import validation_report
from fareloom.operators.merge import scd1_merge
from fareloom.operators.reference import clean_reference
from fareloom.sources.readers import fetch
from fareloom.sources.spec import SourceSpec, landing_path

STATUS_SCHEMA = "source string, status string, detail string, landed_at string, row_count bigint"

#: Publishes the next state of a named table.
Publish = Callable[[str, DataFrame], None]


def land(df: DataFrame, root: str, spec: SourceSpec) -> str:
    """Write the rows in their own format under the landing rule; returns the path."""
    path = f"{root.rstrip('/')}/{landing_path(spec)}"
    writer = df.write.mode("overwrite")
    if spec.kind == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.parquet(path)
    return path


def ingest(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    root: str,
    tables: dict[str, DataFrame] | None = None,
    publish: Publish | None = None,
) -> DataFrame:
    """Ingest every source; a bad one is reported and the next one goes on.

    Parquet sources are landed as they are. CSV sources are cleaned, landed and, if
    they name a destination table, merged into it by primary key and handed to
    ``publish``. Returns one status row per source.
    """
    outcome = []
    for spec in specs:
        try:
            outcome.append(_ingest_one(spark, spec, root, tables or {}, publish))
        except Exception as error:  # noqa: BLE001 - one source must not stop the others
            outcome.append((spec.name, "FAILED", str(error).splitlines()[0], None, None))
    return spark.createDataFrame(outcome, STATUS_SCHEMA)


def _ingest_one(
    spark: SparkSession,
    spec: SourceSpec,
    root: str,
    tables: dict[str, DataFrame],
    publish: Publish | None,
) -> tuple:
    raw = fetch(spark, spec)
    report = validation_report(
        raw,
        spec.required_columns,
        spec.primary_key,
        dict(spec.renames),
        refuse_empty=spec.kind == "parquet",
    ).first()
    if report.row_count == 0:
        return spec.name, "SKIPPED", "no rows", None, 0
    if not report.is_valid:
        return spec.name, "INVALID", report.summary, None, report.row_count
    cleaned = raw if spec.kind == "parquet" else clean_reference(raw, dict(spec.renames))
    path = land(cleaned, root, spec)
    if spec.kind == "csv" and spec.destination_table and publish and spec.primary_key:
        landed_rows = cleaned
        target = tables.get(spec.destination_table)
        merged = landed_rows if target is None else scd1_merge(target, landed_rows, [spec.primary_key])
        publish(spec.destination_table, merged)
        return spec.name, "LOADED", spec.destination_table, path, report.row_count
    return spec.name, "LANDED", spec.kind, path, report.row_count
