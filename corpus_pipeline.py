"""A corpus from raw documents to packed token sequences, each stage written and read again."""

from __future__ import annotations

from pairsignal.llm import line_dedup, ngram_join, packing, substring_dedup, toxicity
from pairsignal.llm.tables import stored, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("line_dedup", line_dedup.stage),
    ("ngram_join", ngram_join.stage),
    ("substring_dedup", substring_dedup.stage),
    ("packing", packing.stage),
]

# Learned scores, whole-text alignment and tokenizers have no SQL; tests/llm/test_pipeline.py
# compares with a plain version.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    rows = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir))
    return rows
