"""Documents to training text, stage by stage: each stage is written and read again by the next.

A stage takes the rows its predecessor kept, with the columns of ``documents``. Texts that
are null or without words are not toxic, not duplicates, not contaminated and hold no
personal data; they pass. Rows with a null ``doc_id`` pass too, and rows that repeat a
``doc_id`` share its fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replivote.llm import pii
from replivote.llm import toxicity as toxic
from replivote.llm.common import quoted, stored, table
from replivote.llm.contamination import decontaminate
from replivote.llm.minhash import deduplicated
from replivote.llm.mixing import mix
from replivote.llm.queries import toxicity_chain


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain of classifiers does not find toxic."""
    chain = toxicity_chain(docs, table(spark, sf_dir, "labels"))
    return toxic.judged(docs, chain).where("p_toxic < 0.5").select(*[quoted(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, on shingles of five words."""
    return deduplicated(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and their length counted anew."""
    model = pii.fit(pii.labelled_parts(docs))
    masked = pii.masked(docs, model).withColumn("n_chars", F.length("text").cast("long"))
    return masked.select(*[quoted(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]

#: SQL has no trained models, bands of registers or Viterbi paths; the tests compare each stage with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
