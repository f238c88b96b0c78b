"""A training-text pipeline over ``documents``: each stage reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, jaccard, pieces, pii, rules
from tidewater.session import materialise
from tidewater.tables import Tables

#: Near copies: word n-grams and the least Jaccard similarity in percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the quality rules go; NULL, empty and short texts (below 50 words) are among them.

    Repeated rows get the same verdict, all columns stay as they are, no rows give no rows.
    """
    return rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays, that of the least id.

    NULL and empty texts are copies of nothing and stay; of fully repeated rows one stays. Other columns are not read.
    """
    return jaccard.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go; NULL and empty texts have none and stay. Other columns are not read."""
    return decontaminate.without_benchmark(docs, Tables(spark, sf_dir).benchmark)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in its text is replaced and ``n_chars`` is set to the new length.

    NULL and empty texts stay as they are, equal texts are changed alike, other columns keep their values whatever their names.
    """
    return pii.sanitised(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its pieces in ``ids`` (replacing a column of that name) and their number in ``n_pieces``.

    NULL and empty texts have no pieces; texts of any length are coded whole.
    """
    import public_tokenizers

    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model")).withColumn("n_pieces", F.size("ids").cast("long"))


STAGES = [
    ("quality_rules", quality),
    ("near_copies", near_copies),
    ("benchmark_decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", tokens),
]

#: The stages use measures that SQL cannot express; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
