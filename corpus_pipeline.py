"""Corpus pipeline over ``documents``: language ID, line dedup, near-duplicate
removal, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; what it returns is written as Parquet to the shared folder and read
again as the next one's input, so a lost executor costs a stage at most. All
stages but the last return the columns of ``docs``:

* ``language_id`` drops documents without a language (null text, no letter), and
  writes the predicted language where ``lang`` is null;
* ``line_dedup`` cuts repeated lines out of ``text`` (and follows in ``n_chars``), and
  drops documents that lose all their words by it: all they say is in others;
* ``jaccard_join`` keeps one document of each class of near duplicates of what is left;
* ``decontaminate`` drops documents that hold a window of a benchmark item;
* ``packing`` returns the pieces of the rest with their sequences.

Line dedup comes before near duplicates, so near copies mostly lose their common
lines there and meet the later stage as what sets them apart; ``jaccard_join`` judges that
remainder.

Defined results: documents with a null or empty text go in the first stage, so no empty
text reaches packing. A null doc_id is one like others: a document smaller than all in line
dedup. Rows with equal doc_id and text share one class, and one row of it
stays. Of documents of equal texts the smallest doc_id stays. Other columns pass through as they are. An empty table gives an
empty result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrearly.llm import decontaminate, jaccard_join, language_id, line_dedup, packing
from arrearly.llm.common import ship, table, written


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return language_id.keep_known(docs, language_id.learn(language_id.training_rows(docs), most=None))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, drop_emptied=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(ship(spark), sf_dir, "benchmark"), remove="documents")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.contract(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

# SQL cannot express the language model, the forest or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
