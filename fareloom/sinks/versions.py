"""Comparison of snapshots of a table: facts, schema evolution, differences, evidence.

A snapshot is a plain parquet folder that the caller names; what a change does to a table
is a DataFrame expression, and its result is the next snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def keep_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write a snapshot and read it back; a folder that exists already is refused."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def appended(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The table with further rows; a column that only they have reads NULL in the others."""
    return table.unionByName(rows, allowMissingColumns=True)


def operations(done: Sequence[tuple[int, str, DataFrame]]) -> DataFrame:
    """One row for each snapshot: version, operation and row count."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(version).alias("version"), F.lit(operation).alias("operation"), "row_count"
        )
        for version, operation, df in done
    ]
    return reduce(DataFrame.unionAll, rows)


def snapshot_facts(
    df: DataFrame, label: str, probe_key: Column, probe_column: str, evolved_column: str
) -> DataFrame:
    """One row on a version: row count, columns, whether it has evolved, a probed value."""
    evolved = evolved_column in df.columns
    missing = F.count_if(F.col(evolved_column).isNull()) if evolved else F.lit(None).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(F.when(probe_key, F.col(probe_column))).alias("probe_value"),
        missing.alias("null_in_evolved_column"),
    ).select(
        F.lit(label).alias("label"),
        "row_count",
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(evolved).alias("has_evolved_column"),
        "probe_value",
        "null_in_evolved_column",
    )


def evolution_checks(
    first: DataFrame, second: DataFrame, current: DataFrame, history: DataFrame,
    updated_value: str, added: DataFrame,
) -> DataFrame:
    """Eight assertions over create, update and evolving append, as (check_name, passed).

    The first three frames come from :func:`snapshot_facts`, ``history`` from
    :func:`operations`; ``added`` is a one-cell frame with the number of rows the append added.
    """
    def cell(df: DataFrame, name: str) -> Column:
        return df.select(name).scalar()

    checks = {
        "history_has_three_versions": cell(history.agg(F.count(F.lit(1)).alias("n")), "n") == 3,
        "v0_has_original_schema": ~cell(first, "has_evolved_column"),
        "v1_has_original_schema": ~cell(second, "has_evolved_column"),
        "current_has_evolved_schema": cell(current, "has_evolved_column"),
        "v0_retains_original_value": ~cell(first, "probe_value").eqNullSafe(F.lit(updated_value)),
        "v1_shows_updated_value": cell(second, "probe_value").eqNullSafe(F.lit(updated_value)),
        "row_count_grew_by_appended_rows":
            cell(current, "row_count") == cell(first, "row_count") + added.scalar(),
        "pre_evolution_rows_null_in_new_column":
            cell(current, "null_in_evolved_column") == cell(first, "row_count"),
    }
    entries = [
        F.struct(F.lit(name).alias("check_name"), F.coalesce(value, F.lit(False)).alias("passed"))
        for name, value in checks.items()
    ]
    one = first.select(F.lit(1).alias("_one"))
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def evidence(history: DataFrame, facts: Sequence[DataFrame], checks: DataFrame, path: str) -> None:
    """Write history, snapshot facts, checks and the overall verdict as JSON under ``path``."""
    history.write.mode("overwrite").json(f"{path}/history")
    reduce(DataFrame.unionByName, facts).write.mode("overwrite").json(f"{path}/snapshots")
    checks.write.mode("overwrite").json(f"{path}/checks")
    checks.agg(F.bool_and("passed").alias("all_passed")).write.mode("overwrite").json(
        f"{path}/verdict"
    )


def version_diff(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows added, removed or changed between two versions, by key.

    Columns only one side has are compared as NULL on the other.
    """
    key = list(key)
    columns = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in key]

    def side(df: DataFrame, mark: str) -> DataFrame:
        values = [F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns]
        return df.select(*key, F.struct(*values).alias(mark))

    both = side(old, "_old").join(side(new, "_new"), key, "full_outer")
    differing = [
        F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in columns
    ]
    kind = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.size(F.array_compact(F.array(*differing))) > 0, "changed")
    )
    return both.withColumn("change", kind).filter(F.col("change").isNotNull()).select(
        *key,
        "change",
        F.when(F.col("change") == "changed", F.concat_ws(",", *differing)).alias("changed_columns"),
    )
