"""The corpus pipeline: documents in, a deduplicated and mixed training set out.

Each stage reads all rows its predecessor kept.  A document goes if it is predicted toxic,
has no recognisable language, is a near copy of one of a smaller id, or holds benchmark
text; what stays is repeated or dropped to reach the target weights of the sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, langid, mixing, neardup, toxicity
from tidemark.llm.storage import stored

STAGES = [
    ("toxicity", toxicity.stage),
    ("language_id", langid.stage),
    ("near_dedup", neardup.stage),
    ("decontamination", decontamination.stage),
    ("mixing", mixing.stage),
]

#: Learned models and links between documents are beyond SQL; tests compare the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
