"""A corpus pipeline of five of the training-data operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents
it keeps (the last one the packed pieces). Each stage's result is written as Parquet and read back
as the next one's documents. Nulls, empty texts, repeated rows and empty tables are handled as each
operator's docstring says; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oeeflow.llm.common import table, word_count, written
from oeeflow.llm.mixing import apply_mix
from oeeflow.llm.packing import best_fit_pack, pieces
from oeeflow.llm.pii import redact
from oeeflow.llm.quality import quality_rules
from oeeflow.llm.simjoin import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules(docs).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, Jaccard 0.8) the smallest id stays."""
    return keep_one(docs, shingle=5, threshold=0.8)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; ``n_chars`` follows the text."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until the sources have their target weights."""
    return apply_mix(docs, word_count(F.col("text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, packed into sequences of 4096."""
    import public_tokenizers
    return best_fit_pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mix_sources", mixing), ("best_fit_packing", packing)]

#: SQL can express neither the anchors and parsers of personal data nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
