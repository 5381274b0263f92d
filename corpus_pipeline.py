"""The corpus pipeline: language ID, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's result to the shared folder as
Parquet and gives it to the next as docs. All stages but the last return the columns of docs, whatever others these have. An
empty table of documents gives no rows. Ids are whole numbers; texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import best_fit, decontaminate, language_id, simhash_forest, substring_dedup
from corpusloom.llm.common import mark, materialize, release, release_since, table
from corpusloom.session import ship


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised.

    Null, empty and letterless texts go. Null and repeated ids are rows like any other. Without any labelled text nothing is kept.
    """
    ship(spark)
    return language_id.identify(docs, language_id.train(docs), only_accepted=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of exact and near copies: the one of the least id.

    Null ids, and null, empty and wordless texts, stay. Rows that repeat an id are one document, and stay or go together.
    """
    ship(spark)
    return simhash_forest.drop_near_duplicates(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that stand in an earlier place of the corpus out of the texts; documents of which no word stays go.

    Earlier is by (id, start). Null ids, and null, empty and blank texts, stay as they are. Rows that repeat an id are one document:
    each loses the same passages.
    """
    ship(spark)
    return substring_dedup.remove_repeats(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no copy of a benchmark item.

    Null ids, and null, empty and wordless texts, stay. Rows that repeat an id stay or go together.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into training sequences of 2048 words at most.

    Null, empty and blank texts give no pieces. Rows of a null or repeated id are documents of their own.
    """
    ship(spark)
    return best_fit.pack(docs, with_text=True)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents. Of the tables on the way, only what the result reads stays."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        point, had = mark(), docs
        docs = materialize(stage(spark, docs, sf_dir))
        release_since(point, docs)
        release(had)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Kernels, signatures and alignment are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None
