"""The corpus pipeline: quality rules, near-duplicates, benchmark passages, secrets, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows to the shared folder and
reads them again for the next. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareloom.llm.common import stored, table
from fareloom.llm.decontamination import stage_decontamination
from fareloom.llm.piece_tokens import stage_sentencepiece
from fareloom.llm.quality_rules import stage_quality_rules
from fareloom.llm.secret_scan import stage_secret_scan
from fareloom.llm.simhash import stage_simhash

STAGES = [
    ("quality_rules", stage_quality_rules),
    ("simhash", stage_simhash),
    ("decontamination", stage_decontamination),
    ("secret_scan", stage_secret_scan),
    ("sentencepiece", stage_sentencepiece),
]

#: SQL has no SimHash, BM25 index or SentencePiece; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
