"""The corpus pipeline: toxicity, near-dedup, decontamination, mixing, token records.

Defined results: a null text passes as an empty one; both are scored by the intercept, belong to the class of empty texts
(one document of it stays), have no words to be contaminated or counted by the mix, and give a record of the end id alone.
Null sources are one source, rows with a null doc_id are documents like others and come last. Equal rows are copies, of
which near-dedup keeps one. Ties go by the rules of each stage's module. Without documents there are no rows; without
labels nothing is toxic, without benchmark items nothing is contaminated. Other columns, whatever their names, pass
through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.bagminhash import drop_near_duplicates
from millrace.llm.fmindex import decontaminate
from millrace.llm.mixing import mix_sources
from millrace.llm.records import write_tokens
from millrace.llm.toxicity import drop_toxic
from millrace.scratch import stage

STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_records", write_tokens),
]

#: Classifiers, signatures and token records are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
