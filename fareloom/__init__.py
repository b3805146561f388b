"""Batch-first analytics on Spark for trip facts and slowly changing reference data.

Every public function takes DataFrames and returns DataFrames (or a small
container of them); reading and writing happen only in ``sources`` and ``sinks``.
"""

from fareloom.operators.asof import as_of
from fareloom.operators.audit import audit_rows
from fareloom.operators.bi import bi_dataset
from fareloom.operators.checks import run_checks
from fareloom.operators.clean import clean_trips
from fareloom.operators.gold import gold_summaries
from fareloom.operators.history import scd2_merge
from fareloom.operators.matching import match_zones, resolve_current
from fareloom.operators.merge import insert_ignore, scd1_merge
from fareloom.operators.profile import profile
from fareloom.operators.reference import standardise_and_hash
from fareloom.operators.runs import runs_summary
from fareloom.operators.star import build_star
from fareloom.operators.tieout import tie_out
from fareloom.sinks.ingest import ingest
from fareloom.sinks.versions import version_diff
from fareloom.streaming.alarms import alarms

__all__ = [
    "alarms", "as_of", "audit_rows", "bi_dataset", "build_star",
    "clean_trips", "gold_summaries", "ingest", "insert_ignore", "match_zones",
    "profile", "resolve_current", "run_checks", "runs_summary", "scd1_merge",
    "scd2_merge", "standardise_and_hash", "tie_out",
    "version_diff",
]
