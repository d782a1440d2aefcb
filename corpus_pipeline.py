"""The training-data pipeline: quality, near copies, benchmark leaks, personal data, packing.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``docs``, with those rows that the stage keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeledger.llm import decontamination, minhash_dedup, packing, pii, quality
from plumeledger.llm.queries import WORD_TOKENIZER
from plumeledger.llm.shared import Scratch, fresh, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.7 or more, as ``op9`` does."""
    labels = table(spark, sf_dir, "labels")
    net = quality.train(docs, labels, "quality", lambda column: quality.fold(column, 4) == 2)
    (name,) = fresh(docs, "quality_score")
    scored = quality.score(docs, net, name).where(F.col(name) >= 0.7)
    return scored.select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five-word shingles, similarity 0.8)."""
    return minhash_dedup.one_of_each(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item, with or without an id."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10, nameless=True)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    placed = packing.pack(docs, WORD_TOKENIZER, capacity=2048, end_id=1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_copy),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: The classifier and the tokenizer have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the written result of the one before."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.stage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
