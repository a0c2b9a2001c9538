"""From raw documents to token counts: five of the text operators in a row.

Each stage takes (spark, docs, sf_dir) and works on all rows it is given; all
but the last return the columns of ``documents``.  Between stages the rows are
written and read again, which cuts lineage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.llm import line_dedup, mixing, ngram_join, quality_rules, sentencepiece_bpe
from lodestead.llm.text import stored, words

MODEL = "piece_bpe_32k.model"
#: Near copies share this percentage of their shingles of so many words; op4_ngram_join has a contract of its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on many sources; ``n_chars`` follows the text."""
    cleaned = line_dedup.remove_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long"))
    return cleaned.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, the one with the smallest id; rows without an id stay.

    Texts are what is linked: unlike texts that share an id all stay.
    """
    return ngram_join.one_of_each_group(docs, NEAR_WORDS, NEAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: each document as many times as the sources' targets take it."""
    keyed = docs.withColumn("__text", F.xxhash64("text"))
    mixed = mixing.mix(keyed, F.size(words(F.coalesce("text", F.lit("")))), ["doc_id", "__text"])
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mixed.filter("copies > 0").select(*docs.columns, copies.alias("__copy")).drop("__copy")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, as counts and digests."""
    return sentencepiece_bpe.token_digests(docs, public_tokenizers.path(MODEL), "doc_id")


STAGES = [
    ("quality rules", rules),
    ("line dedup", lines),
    ("n-gram near duplicates", near_duplicates),
    ("mixing", mix),
    ("sentencepiece", tokens),
]

#: The dependent rounding of the mixture has no SQL; a test holds the stages against plain Python on a small fixture.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(spark, docs, "pipeline-" + name.replace(" ", "-"))
    return docs
