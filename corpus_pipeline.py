"""The corpus pipeline: quality rules, exact dedup, SimHash near-dedup, PII, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet under ``spark.checkpoint.dir`` and hands the
reread table to the next.  All but the last return the columns of ``documents``.
A stage works on every row its predecessor kept; a null text counts as empty,
and an empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlab.llm.common import DOCUMENT_COLUMNS, materialize, read_table
from feedlab.llm.exact_dedup import keep_one
from feedlab.llm.packing import pack_documents
from feedlab.llm.pii import replace_pii
from feedlab.llm.quality_ledger import DEFAULT_POLICY, ledger, passes
from feedlab.llm.queries import pii_key
from feedlab.llm.simhash import near_duplicates
from feedlab.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the default policy; no join, the ledger carries the rows."""
    judged = ledger(docs, carry=DOCUMENT_COLUMNS)
    return judged.filter(passes(DEFAULT_POLICY)).select(*DOCUMENT_COLUMNS)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts equal without white space."""
    return keep_one(docs).select(*DOCUMENT_COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints: the smallest doc_id, a null one
    last, and of equal ones the first row.  Rows are numbered in a written copy, so
    rows that share an id, or have none, are rows of their own."""
    rows = materialize(docs.select(*DOCUMENT_COLUMNS, F.monotonically_increasing_id().alias("row")), "pipeline-rows")
    groups = near_duplicates(rows, doc_id="row").select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select("row", F.col("doc_id").isNull().alias("without"), "doc_id")
    first = groups.join(ids, "row").groupBy("component_id").agg(F.min(F.struct("without", "doc_id", "row")).alias("x"))
    return rows.join(first.select("x.row"), "row", "left_semi").select(*DOCUMENT_COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; n_chars counts the new text."""
    return (replace_pii(docs.select(*DOCUMENT_COLUMNS), pii_key(spark))
            .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*DOCUMENT_COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 1024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("pii", personal_data),
    ("packing", packing),
]

# SQL has neither the fingerprints' hash nor the tokenizer: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
