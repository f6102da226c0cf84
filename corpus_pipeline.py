"""A corpus from raw documents to token files: five stages, each one operator, written between stages.

Every stage takes (spark, docs, sf_dir) and works on all rows of docs. Rows are judged by their own
texts, also under null and repeated ids: near_dedup keeps one row of each group of alike texts and all
rows without words, decontaminate drops the rows that hold a window and no others. Extra columns are
dropped. Stages of an empty table give an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halala.llm import eliasfano, forest, mixing, passages, wumanber
from halala.llm.fitting import fold
from halala.llm.queries import TARGETS, labelled_domains, tokenizer_file
from halala.llm.shared import given, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
GOOD = 0.3  # least score of a document that is kept
HAS_WORDS = r"coalesce(text, '') rlike r'[^\x20\x09-\x0D]'"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones of them, does not reject."""
    model = passages.fitted(docs, given(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))
    return passages.kept(docs.select(*COLUMNS), model, GOOD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id, once.

    Rows are told apart by id and text, so documents without an id or under a repeated one are judged
    by their own texts. Documents without words are in no group and all stay.
    """
    first = forest.near_duplicates(docs, k=5, least=80).where("first and n_shingles > 0").select("doc_id", "rank").distinct().alias("f")
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("rank"))
    once = rows.where(HAS_WORDS).dropDuplicates(["doc_id", "rank"]).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.rank") == F.col("f.rank"))
    return once.join(first, same, "left_semi").union(rows.where(f"not ({HAS_WORDS})")).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return wumanber.clean(docs.select(*COLUMNS), given(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, and those of scarce languages more often, towards the target shares."""
    listed = labelled_domains(spark, sf_dir)
    return mixing.mixed(docs.select(*COLUMNS), mixing.rates(docs, listed, TARGETS, keep_all=True))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, as read back."""
    return eliasfano.encoded(docs, tokenizer_file())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]

# The classifiers and the tokenizer are beyond SQL: tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the given documents; each result is written and read again."""
    docs = given(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
