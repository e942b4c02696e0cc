"""A pipeline that turns raw documents into packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents. All but the last keep the columns of
``documents``:

1. language: texts without a recognisable language go;
2. near-dedup: of texts whose SimHash fingerprints link, one stays;
3. substring dedup: words covered by windows that occurred before are cut from the texts;
4. mixing: sources are taken by weight, some documents repeatedly, some not at all;
5. packing: pieces of sequences along a space-filling curve.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.llm import language, mixing, packing, simhash, substrings
from noticeflow.llm.common import unused
from noticeflow.session import written

# EM, star contraction and recompression have no SQL form; the stages have tests instead.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; the model learns from those that are not held out."""
    known = language.fold(docs).filter(~F.col("held_out"))
    languages, model = language.train(known)
    name = unused("language", docs.columns)
    found = language.identify(docs, languages, model, name)
    return found.filter(F.col(name)["lang_pred"] != "und").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id.

    Four-word shingles and at most four differing bits, as in the operator's own query.
    """
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occurred before; untouched texts keep their white space."""
    return substrings.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, a row for each time a document is taken."""
    return mixing.mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result but the last is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
