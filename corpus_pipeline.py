"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept; its result is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``. Rows with a null doc_id are
kept where a decision needs an id. Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelog.llm import pieces, pii, setsketch, tiling, toxicity
from tidelog.llm.common import DOCUMENT_COLUMNS, in_fold, materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. Labels are learned from the same
    four fifths of the documents as in the operator's own query."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~in_fold("doc_id", 5, 0))
    return toxicity.score(docs, model, keep=DOCUMENT_COLUMNS).where("predicted = 0").select(*DOCUMENT_COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity of 0.8 or
    more) the smallest doc_id stays. Repeated rows of one id are one document."""
    found = setsketch.near_duplicates(docs, threshold=0.8)
    gone = materialize(found.where("not kept").select("doc_id").distinct())
    return docs.select(*DOCUMENT_COLUMNS).join(gone, "doc_id", "left_anti").select(*DOCUMENT_COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover half of a benchmark item or more go."""
    found = tiling.contaminated(docs, table(spark, sf_dir, "benchmark"))
    gone = materialize(found.select("doc_id").distinct())
    return docs.select(*DOCUMENT_COLUMNS).join(gone, "doc_id", "left_anti").select(*DOCUMENT_COLUMNS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind; n_chars follows the text."""
    done = pii.redact(docs.select(*DOCUMENT_COLUMNS))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to the text."""
    return pieces.with_pieces(docs.select("doc_id", "text")).select("doc_id", "n_tokens", "ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_pii),
    ("sentencepiece", encode),
]

#: SQL cannot express the learned and tiled stages; tests hold them against
#: plain re-statements instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each one's result is written to the
    shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
