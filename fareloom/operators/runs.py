"""Run history: terminal runs, run statistics, log summaries, failures and alarms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fareloom.functions.temporal import elapsed_seconds
from fareloom.operators.merge import insert_ignore, new_rows

# Run states and the marker of a summary line.
TERMINAL_STATES = ("SUCCEEDED", "FAILED", "STOPPED", "TIMEOUT", "ERROR")
FAILURE_STATES = ("FAILED", "TIMEOUT", "ERROR")
SUMMARY_MARKER = "Final job summary"
SUMMARY_SCHEMA = (
    "job_name string, status string, start_time string, end_time string, "
    "duration_seconds double, execution_summary map<string,string>"
)
COUNTERS = ("inserted", "updated", "no_change")


def terminal_runs(runs: DataFrame) -> DataFrame:
    """Finished runs: terminal state, and both times known."""
    return runs.filter(
        F.col("status").isin(*TERMINAL_STATES)
        & F.col("started_at").isNotNull()
        & F.col("completed_at").isNotNull()
    )


def failed_runs(runs: DataFrame, jobs: list[str] | None = None) -> DataFrame:
    """Runs in a failed state, of the named jobs or of all. Works on streams too."""
    failed = F.col("status").isin(*FAILURE_STATES)
    return runs.filter(failed & F.col("job_name").isin(*jobs) if jobs else failed)


def parse_summaries(lines: DataFrame) -> DataFrame:
    """Summary records in log lines (``run_id``, ``line_no``, ``message``).

    The JSON starts at the first brace after the marker line is recognised; lines
    without a brace or with text that does not parse are skipped.
    """
    text = F.when(F.instr("message", "{") > 0, F.expr("substring(message, instr(message, '{'))"))
    return (
        lines.filter(F.col("message").contains(SUMMARY_MARKER))
        .withColumn("_summary", F.from_json(text, SUMMARY_SCHEMA))
        .filter(F.size(F.coalesce(F.col("_summary.execution_summary"), F.create_map())) > 0)
        .select("run_id", "line_no", "_summary.*")
    )


def processed(execution_summary: str = "execution_summary") -> Column:
    """Inserted plus updated plus unchanged; errors are not counted, absent counters are zero."""
    parts = [
        F.coalesce(F.col(execution_summary)[name].try_cast("long"), F.lit(0)) for name in COUNTERS
    ]
    return parts[0] + parts[1] + parts[2]


def records_processed(lines: DataFrame) -> DataFrame:
    """Records processed by each run, from its first summary line with counters."""
    return (
        parse_summaries(lines)
        .select("run_id", "line_no", processed().alias("records"))
        .groupBy("run_id")
        .agg(F.min_by("records", "line_no").alias("records_processed"))
    )


def collect_runs(runs: DataFrame, lines: DataFrame) -> DataFrame:
    """Run history rows: finished runs with their processed count, NULL if none was logged."""
    finished = terminal_runs(runs).drop("records_processed")
    return finished.join(records_processed(lines), "run_id", "left").select(
        "run_id", "job_name", "status", "records_processed", "started_at", "completed_at"
    )


def sync_runs(history: DataFrame, runs: DataFrame, arrival: str | None = None) -> DataFrame:
    """Run history after adding the finished runs it does not hold yet.

    Of several deliveries of a new run the first by ``arrival`` enters.
    """
    return insert_ignore(history, terminal_runs(runs), ["run_id"], arrival)


def added_runs(history: DataFrame, runs: DataFrame, arrival: str | None = None) -> DataFrame:
    """Number of runs a sync adds."""
    return new_rows(history, terminal_runs(runs), ["run_id"], arrival).agg(
        F.count(F.lit(1)).alias("rows_added")
    )


def run_view(runs: DataFrame) -> DataFrame:
    """Runs with their duration in seconds, NULL while unfinished."""
    return runs.select(
        "run_id",
        "job_name",
        "status",
        "records_processed",
        "started_at",
        "completed_at",
        elapsed_seconds("started_at", "completed_at").alias("execution_time_seconds"),
    )


def runs_summary(runs: DataFrame, seconds: str = "execution_seconds") -> DataFrame:
    """Per job: runs, succeeded runs, whole average and maximum seconds of the succeeded."""
    ok = F.col("status") == "SUCCEEDED"
    spent = F.when(ok, F.coalesce(F.col(seconds), F.lit(0)).cast("long"))
    return runs.groupBy("job_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(ok).alias("succeeded"),
        F.coalesce(F.floor(F.sum(spent) / F.nullif(F.count(spent), F.lit(0))), F.lit(0))
        .cast("long").alias("avg_seconds"),
        F.coalesce(F.max(spent), F.lit(0)).alias("max_seconds"),
    )


def status_tally(runs: DataFrame) -> DataFrame:
    """Number of runs by state."""
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("runs"))


@dataclass(frozen=True)
class Alarm:
    """One threshold over tumbling windows of a metric.

    ``statistic`` is ``sum`` or ``max``; ``inclusive`` makes the threshold itself a breach.
    """

    name: str
    metric: str
    statistic: str
    period: str
    threshold: float
    inclusive: bool


# The four alarms (statistic, period, threshold).
ALARMS = (
    Alarm("execution_failed", "failed", "sum", "300 seconds", 1, True),
    Alarm("execution_timed_out", "timed_out", "sum", "300 seconds", 1, True),
    Alarm("execution_duration_high", "duration_ms", "max", "300 seconds", 2_700_000, False),
    Alarm("compute_seconds_high", "compute_seconds", "sum", "86400 seconds", 43_200, False),
)


def seconds_of(alarm: Alarm) -> int:
    """Length of the alarm's window."""
    return int(alarm.period.split()[0])


def breaching(metric: DataFrame, alarm: Alarm) -> DataFrame:
    """Windows at or over the threshold, as the alarm compares."""
    over = F.col("value") >= alarm.threshold if alarm.inclusive else F.col("value") > alarm.threshold
    return metric.filter(over)
