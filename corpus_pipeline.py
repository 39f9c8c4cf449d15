"""A corpus pipeline: quality, exact copies, near copies, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet in the cluster's shared folder and reads again as the next
stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tsforge.llm import bpe, exact_dedup, mixing, near_copies, quality
from tsforge.llm.common import discard, table, tables_written, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.fit(quality.described(docs), table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word shingles, similarity 0.8 or more) one stays."""
    return near_copies.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.Mix(docs).documents()


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document and the digests of a round trip."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", to_tokens),
]

#: No SQL expresses the classifier; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written; what only they needed is deleted as soon as the next is there."""
    docs, last = table(spark, sf_dir, "documents"), []
    for number, (_, stage) in enumerate(STAGES, 1):
        before = tables_written()
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
        *between, own = [path for path in tables_written() if path not in before]
        discard(spark, between + last)
        last = [own]
    return docs
