"""The corpus pipeline: quality rules, near-duplicates, decontamination, personal data, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``; every stage works on all rows its predecessor kept.

1. quality_rules    documents that the rules or the compression bands reject go
2. near_dedup       one document of each near-duplicate group stays, the one of the smallest id
3. decontaminate    documents made up of benchmark passages go
4. personal_data    all documents stay; personal data and disclosing terms are replaced
5. tokens           byte-level BPE ids of every document, decoded again

SQL cannot express a stage (zstandard, sketches, tokenizers), so ``ORACLE_SQL`` is None; the
tests hold ``run`` against brute-force versions of the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, decontam, near_dedup, pii, quality_rules
from strata.llm.common import Scratch, documents

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("near_dedup", near_dedup.stage),
    ("decontaminate", decontam.stage),
    ("personal_data", pii.stage),
    ("tokens", bpe.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written to the shared folder, so a lost
    executor costs the current stage only."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
