"""SCD Type 2: versioned records with half-open validity intervals.

A history table has the business key, its attributes, ``record_hash``,
``version``, ``is_current``, ``effective_date``, ``end_date`` and a surrogate row
id. A merge compares a batch with the current rows and yields the next history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window, functions as F

from fareloom.operators.dedupe import semi_join_counted
from fareloom.operators.keys import assign_ids, highest_id
from fareloom.operators.slices import SLICE_ROWS, cut_slices, with_slices
from fareloom.session import shared_dir

INSERTED, UPDATED, NO_CHANGE, ERROR = "INSERTED", "UPDATED", "NO_CHANGE", "ERROR"

#: History columns, where they exist, with the time a row was added and last changed.
CREATED_AT, UPDATED_AT = "created_at", "updated_at"


@dataclass(frozen=True)
class MergeResult:
    """Outcome of a merge; every member is a lazy frame over the stored changes.

    ``history``  the next table: untouched, expired and new rows
    ``created``  new rows, with ``status`` INSERTED or UPDATED
    ``expired``  formerly current rows, now closed
    ``replaced`` the same rows as they were before the merge, and ``closed_at``
    ``statuses`` number of batch rows by status
    ``rejects``  batch rows that cannot be applied, with ``reason``
    ``closing``  the columns that closing a version sets, by name, over ``closed_at``
    """

    history: DataFrame
    created: DataFrame
    expired: DataFrame
    replaced: DataFrame
    statuses: DataFrame
    rejects: DataFrame
    closing: Mapping[str, Column] = field(default_factory=dict)


def empty_history(batch: DataFrame, key: str, attributes: Sequence[str], row_id: str) -> DataFrame:
    """A history table without rows, typed after ``batch``."""
    types = dict(batch.dtypes)
    columns = [f"`{row_id}` bigint", f"`{key}` {types[key]}"]
    columns += [f"`{a}` {types[a]}" for a in attributes]
    columns += ["record_hash string", "version int", "is_current boolean"]
    columns += ["effective_date timestamp_ntz", "end_date timestamp_ntz"]
    return batch.sparkSession.createDataFrame([], ", ".join(columns))


def scd2_merge(
    history: DataFrame,
    batch: DataFrame,
    key: str,
    attributes: Sequence[str],
    effective: str | Column | None = None,
    *,
    arrival: str | None = None,
    row_id: str = "golden_zone_row_id",
    recorded: str | Column | None = None,
    numbered: Sequence[str] = (),
    defaults: Mapping[str, Column] | None = None,
    store_changes: bool = True,
    slice_rows: int = SLICE_ROWS,
) -> MergeResult:
    """Apply ``batch`` (key, attributes, ``record_hash``) to ``history``.

    ``effective`` is the time the changes take effect: one time for the whole
    batch (text or literal; the current time when left out), or a column of the
    batch together with ``arrival``, a unique whole number giving the order of
    the rows. With ``arrival`` a key may change several times in one batch and
    gets one version per change. Without it a key may repeat only with equal
    hashes; differing rows of one key have no order and are rejected.

    The history may have more columns. ``created_at`` and ``updated_at`` of new rows and
    ``updated_at`` of closed rows are set to ``recorded``, the time of the merge (now when
    left out). New rows number on in the columns ``numbered``, take the values of
    ``defaults``, and have NULL in the rest. Ids of a key's new rows follow its versions.

    The changes feed the new rows, the closed rows, the audit and the counts. They
    are computed once and stored in the shared folder, which also makes them
    survive a lost executor; ``store_changes=False`` computes them again for each use.
    With ``arrival`` a batch of more than ``slice_rows`` rows is looked at first, to cut
    keys of more rows than that into slices.
    """
    when = _effective(effective)
    rejects = batch.filter(F.col(key).isNull()).withColumn(
        "reason", F.lit(f"{key} must not be null")
    )
    keyed = batch.filter(F.col(key).isNotNull())
    current = history.filter("is_current")
    if arrival is None:
        changes, ambiguous = _single_changes(current, keyed, key, attributes, when)
        rejects = rejects.unionByName(ambiguous, allowMissingColumns=True)
    else:
        changes = _chained_changes(current, keyed, key, attributes, when, arrival, slice_rows)
    if store_changes:
        path = shared_dir(batch.sparkSession, "scd2-changes")
        changes.write.parquet(path)
        changes = batch.sparkSession.read.schema(changes.schema).parquet(path)
    stamp = _recorded(recorded)
    highest = highest_id(history, row_id)
    created = assign_ids(changes, [key], row_id, start_after=highest, in_order="version")
    created = _filled(created, history, row_id, highest, stamp, numbered, defaults or {})

    first_change = changes.filter("_first").select(
        F.col(key), F.col("effective_date").alias("_closed_at")
    )
    touched = current.join(first_change, key, "left").select(
        *[F.col(c) for c in history.columns], "_closed_at"
    )
    replaced_all = touched.filter(F.col("_closed_at").isNotNull())
    closing = {"is_current": F.lit(False), "end_date": F.col("_closed_at")}
    if UPDATED_AT in history.columns:
        closing[UPDATED_AT] = stamp.cast(history.schema[UPDATED_AT].dataType)
    expired = replaced_all.withColumns(closing).select(*history.columns)
    new_rows = created.select(*history.columns)
    kept = touched.select(
        *[
            F.when(F.col("_closed_at").isNotNull(), closing[c]).otherwise(F.col(c)).alias(c)
            if c in closing
            else F.col(c)
            for c in history.columns
        ]
    )
    closed = history.filter(~F.coalesce(F.col("is_current"), F.lit(False)))
    return MergeResult(
        history=closed.unionByName(kept).unionByName(new_rows),
        created=created,
        expired=expired,
        replaced=replaced_all.withColumnRenamed("_closed_at", "closed_at"),
        statuses=_status_counts(batch, changes, rejects),
        rejects=rejects,
        closing=closing | {"end_date": F.col("closed_at")},
    )


def _effective(effective: str | Column | None) -> Column:
    if effective is None:
        return F.current_timestamp().cast("timestamp_ntz")
    value = F.lit(effective) if isinstance(effective, str) else effective
    return value.cast("timestamp_ntz")


def _recorded(recorded: str | Column | None) -> Column:
    """The time of the merge; one value for all uses, however often they are computed."""
    if isinstance(recorded, str):
        return F.lit(recorded).cast("timestamp_ntz")
    return F.lit(datetime.now(timezone.utc)) if recorded is None else recorded


def _filled(
    created: DataFrame,
    history: DataFrame,
    row_id: str,
    highest: DataFrame,
    stamp: Column,
    numbered: Sequence[str],
    defaults: Mapping[str, Column],
) -> DataFrame:
    """New rows with the history's further columns."""
    values = {}
    for field in history.schema:
        name = field.name
        if name in created.columns:
            continue
        if name in numbered:
            value = F.col(row_id) - F.coalesce(highest.scalar(), F.lit(0)) + highest_id(history, name).scalar()
        elif name in defaults:
            value = defaults[name]
        else:
            value = stamp if name in (CREATED_AT, UPDATED_AT) else F.lit(None)
        values[name] = value.cast(field.dataType)
    return created.withColumns(values) if values else created


def _status_counts(batch: DataFrame, changes: DataFrame, rejects: DataFrame) -> DataFrame:
    """Rows by status; what is neither a change nor rejected is a row without change."""
    made = changes.groupBy("status").agg(F.count(F.lit(1)).alias("rows"))
    refused = rejects.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(ERROR).alias("status"), "rows")
    every = batch.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(NO_CHANGE).alias("status"), "rows")
    judged = made.unionAll(refused)
    taken = judged.select(F.lit(NO_CHANGE).alias("status"), (-F.col("rows")).alias("rows"))
    return (
        judged.unionAll(every)
        .unionAll(taken)
        .groupBy("status")
        .agg(F.sum("rows").alias("rows"))
        .filter(F.col("rows") > 0)
    )


def _current_side(current: DataFrame, key: str) -> DataFrame:
    return current.select(
        F.col(key),
        F.col("record_hash").alias("_cur_hash"),
        F.col("version").alias("_cur_version"),
        F.lit(True).alias("_known"),
    )


def _single_changes(
    current: DataFrame, keyed: DataFrame, key: str, attributes: Sequence[str], when: Column
) -> tuple[DataFrame, DataFrame]:
    """At most one change per key. Copies of a key are combined before the shuffle."""
    hash_or_blank = F.coalesce(F.col("record_hash"), F.lit(""))
    per_key = keyed.groupBy(key).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.min(hash_or_blank).alias("_low"),
        F.max(hash_or_blank).alias("_high"),
        F.min(F.struct("record_hash", *attributes)).alias("_row"),
    )
    clear = per_key.filter(F.col("_low") == F.col("_high")).select(key, "_copies", "_row.*")
    unclear = per_key.filter(F.col("_low") != F.col("_high")).select(key, "_copies")
    ambiguous = semi_join_counted(keyed, unclear, [key]).withColumn(
        "reason", F.lit("several differing rows for one key and no arrival order")
    )
    judged = clear.join(_current_side(current, key), key, "left").withColumn(
        "status",
        F.when(F.col("_known").isNull(), INSERTED)
        .when(F.col("_cur_hash").eqNullSafe(F.col("record_hash")), NO_CHANGE)
        .otherwise(UPDATED),
    )
    changes = judged.filter(F.col("status") != NO_CHANGE).select(
        key,
        *attributes,
        "record_hash",
        (F.coalesce(F.col("_cur_version"), F.lit(0)) + 1).cast("int").alias("version"),
        F.lit(True).alias("is_current"),
        when.alias("effective_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
        "status",
        F.lit(True).alias("_first"),
    )
    return changes, ambiguous


def _chained_changes(
    current: DataFrame,
    keyed: DataFrame,
    key: str,
    attributes: Sequence[str],
    when: Column,
    arrival: str,
    slice_rows: int,
) -> DataFrame:
    """Every change of every key, in arrival order.

    A row is a change when its hash differs from the row before it. Windows run
    over (key, slice), so a key holding a third of the batch is spread over many
    tasks. Slices have about ``slice_rows`` rows, whether arrivals are dense or far
    apart. They are then linked through one summary row each: the last hash going
    in, the changes so far, and the next change time.
    """
    cuts = cut_slices(keyed, key, arrival, slice_rows)
    sliced = with_slices(keyed, cuts, key, F.col(arrival)).withColumn("_at", when)
    inside = Window.partitionBy(key, "_slice").orderBy(arrival)
    across = Window.partitionBy(key).orderBy("_slice")

    links = (
        sliced.groupBy(key, "_slice")
        .agg(F.max_by(F.struct("record_hash"), arrival).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(across))
        .join(_current_side(current, key), key, "left")
        .select(
            key,
            "_slice",
            F.coalesce(
                F.col("_carried"),
                F.when(F.col("_known"), F.struct(F.col("_cur_hash").alias("record_hash"))),
            ).alias("_before_slice"),
            F.coalesce(F.col("_cur_version"), F.lit(0)).alias("_base"),
            F.col("_known").isNotNull().alias("_was_known"),
        )
    )
    before = F.coalesce(F.lag(F.struct("record_hash")).over(inside), F.col("_before_slice"))
    judged = (
        sliced.join(links, [key, "_slice"])
        .withColumn("_before", before)
        .withColumn(
            "_change",
            F.col("_before").isNull()
            | ~F.col("_before.record_hash").eqNullSafe(F.col("record_hash")),
        )
    )
    changed = judged.filter("_change")
    spans = (
        changed.groupBy(key, "_slice")
        .agg(F.count(F.lit(1)).alias("_in_slice"), F.min_by("_at", arrival).alias("_opens"))
        .select(
            key,
            "_slice",
            F.coalesce(
                F.sum("_in_slice").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_earlier"),
            F.lead("_opens").over(across).alias("_next_opens"),
        )
    )
    placed = (
        changed.join(spans, [key, "_slice"])
        .withColumn("_step", F.col("_earlier") + F.row_number().over(inside))
        .withColumn("_ends", F.coalesce(F.lead("_at").over(inside), F.col("_next_opens")))
    )
    return placed.select(
        key,
        *attributes,
        "record_hash",
        (F.col("_base") + F.col("_step")).cast("int").alias("version"),
        F.col("_ends").isNull().alias("is_current"),
        F.col("_at").alias("effective_date"),
        F.col("_ends").alias("end_date"),
        F.when(F.col("_was_known") | (F.col("_step") > 1), UPDATED)
        .otherwise(INSERTED)
        .alias("status"),
        (F.col("_step") == 1).alias("_first"),
    )


def history_violations(history: DataFrame, key: str) -> DataFrame:
    """SCD invariants as check rows: name and number of violating rows or keys."""
    current = F.coalesce(F.col("is_current"), F.lit(False))
    per_row = history.agg(
        F.count_if(F.col("version").isNull() | F.col("is_current").isNull()
                   | F.col("effective_date").isNull()).alias("missing_columns"),
        F.count_if(F.col("version") < 1).alias("version_below_one"),
        F.count_if(F.col("end_date") <= F.col("effective_date")).alias("empty_interval"),
        F.count_if(current & F.col("end_date").isNotNull()).alias("closed_but_current"),
    )
    rows = per_row.select(
        F.stack(
            F.lit(4),
            F.lit("missing_columns"), F.col("missing_columns"),
            F.lit("version_below_one"), F.col("version_below_one"),
            F.lit("empty_interval"), F.col("empty_interval"),
            F.lit("closed_but_current"), F.col("closed_but_current"),
        ).alias("rule", "violations")
    )
    # Versions 1..n without gaps and at most one current row, from per-key totals.
    per_key = history.groupBy(key).agg(
        F.count_if(current).alias("currents"),
        F.count(F.lit(1)).alias("n"),
        F.min("version").alias("low"),
        F.max("version").alias("high"),
        F.count_distinct("version").alias("versions"),
    )
    keys = per_key.agg(
        F.count_if(F.col("currents") > 1).alias("several_current"),
        F.count_if(
            (F.col("versions") != F.col("n"))
            | (F.col("high") - F.col("low") + 1 != F.col("n"))
        ).alias("version_gap"),
    ).select(
        F.stack(
            F.lit(2),
            F.lit("several_current"), F.col("several_current"),
            F.lit("version_gap"), F.col("version_gap"),
        ).alias("rule", "violations")
    )
    return rows.unionAll(keys)
