"""Training text from raw documents: filter, deduplicate, mix, pack.

Each stage works on all that the one before has kept, and its decisions take effect. What holds
for all of them: null texts count as empty; empty and very long texts, rows that repeat an id or
a whole row, and rows without an id are judged like any others; further columns, whatever their
names, come out as they went in (of the last stage only its own do); without rows in there are
none out. The docstrings say what becomes of nulls, repeats and ties.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import exact, mixing, near, packing, toxicity
from shoplake.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of these, scores below a half.

    Empty texts are scored as texts without any feature. Rows that repeat a text have the same
    score, and stay or go together.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id.

    Null and empty texts are one group. Rows that repeat an id and a text become one, the first
    by their other columns. Rows without an id go where one with an id has their text, and else
    all stay.
    """
    return exact.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of their five-word shingles, the smallest id.

    Empty texts and rows without an id are linked with nothing and stay. Rows that repeat an id
    stay or go by their own text each; those that repeat a text too stay or go together.
    """
    return near.drop_near_copies(docs, shingle=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that the languages have their target weights, as many tokens as there
    are. Languages are known for the documents that have labels, and predicted for all.

    Documents of a language that there is too much of are left out by chance, those of a scarce
    one are there several times. Empty texts have no tokens; like all others they are taken as
    their rate says. Rows that repeat an id and a text are taken equally often.
    """
    known = table(spark, sf_dir, "labels").select("doc_id").distinct()
    labelled = docs.select("doc_id", F.col("lang").alias("domain")).join(known, "doc_id", "left_semi")
    return mixing.drawn(docs, labelled, mixing.LANGUAGES)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens.

    An empty text is one token, the closing one. Every row is packed for itself, with an id or
    without, however often it is there.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# Learned scores and iterative fits: no stage's decision but the second's can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
