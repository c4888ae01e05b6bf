"""A training-data pipeline over ``documents``: five stages, each a Spark job
of one operator.  A stage takes (spark, docs, sf_dir); its result is written
as Parquet and read again as the next one's docs.  All but the last return the
columns of documents.

The stages' classifiers learn from the labelled rows among the documents they
are given, near-duplicate grouping and repeated-passage removal work on all
rows that are left, and the last stage packs what remains.

Defined cases, in every stage: a null text counts as empty and stays null; it
is judged by the classifiers as an empty text, linked with nothing, cut nowhere,
and packed as its end id alone.  Rows without an id stay rows of their own, and
of rows with one id and equal texts one stays.  Extra columns pass through all
stages but the last; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlane.llm import near, packing, quality, repeats, toxicity
from martlane.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier calls toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component (five-word shingles, similarity 0.8 or
    more), the document with the smallest id stays."""
    return near.keep_one(docs, width=5)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by 200-byte strings that occur elsewhere are cut."""
    return repeats.cut_texts(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become sequences of at most 2048 tokens."""
    import public_tokenizers
    return packing.pack(packing.document_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_poor),
    ("MinHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("best-fit packing", pack),
]

# Trained classifiers and tokenizers are not SQL: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
