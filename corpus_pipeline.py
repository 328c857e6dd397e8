"""The corpus pipeline: documents in, token rows out, one stage after another.

Each stage reads what its predecessor kept. The first four return the columns of `documents`; the last writes the
token segments, reads them back and returns each document's place in them. The mix may take a document several times:
it is then that many equal rows.

Cases that all stages share: an empty table gives an empty one. A null text is an empty text, which the quality rules reject;
rows without an id are judged by their text. Extra columns stay, whatever their names, up to the last stage. Ties and repeated
rows: equal rows are rejected or kept alike by rules, decontamination and mix; of rows with one id and text the Jaccard stage
keeps one. A very long text is one document like any other, never cut.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontam, mixing, ngram_join, quality, token_output
from shelfwise.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy rejects go; a null or empty text has too few words."""
    return quality.filter_documents(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the least id; a group without ids keeps one of its texts."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; without items all stay."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, at most three times; a null source is one of its own."""
    return mixing.mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each row, from the written segments, null ids first."""
    return token_output.read_tokens(token_output.write_tokens(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("token-ID / binary output", token_ids),
]
#: Retrieval and tokenization are not expressible in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and reread."""
    *stages, last = STAGES
    docs = reduce(lambda rows, stage: written(stage[1](spark, rows, sf_dir), "stage"), stages, table(spark, sf_dir, "documents"))
    return last[1](spark, docs, sf_dir)
