"""A training corpus from the documents: five stages, each by one operator of ``tremor.llm``.

1. Language ID drops texts without a determinable language, and those that are in none of the learned ones.
2. SimHash near-duplicates: one document of each group stays.
3. Secret scans mask what they find.
4. Mixing takes the sources' words by weight; a text may come up to three times, or in part.
5. BPE coding turns the texts into token ids.

Every stage returns the columns of ``documents`` but the last, which returns a row per mixed text
with its ids. SQL can express neither the language model nor the tokenizer, so there is none;
the tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm.bpe import coded
from tremor.llm.common import documents, numbered_columns, prepared
from tremor.llm.language_id import (
    UNDETERMINED,
    Limits,
    Ppm,
    added_up,
    gram_counts,
    identified,
    learn_counts,
    limits_of_all,
    plausible,
)
from tremor.llm.mixing import Mix, mixed_documents
from tremor.llm.near_dups import first_of_each_group
from tremor.llm.registry import registered
from tremor.llm.secrets import BASE_RULES, MORE_RULES, without_secrets
from tremor.workspace import new_folder

SHINGLE_WORDS = 4
MOST_BITS = 4
LEAST_SCORE = 0.5
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; all labelled documents teach, but their labels decide nothing.

    The score compares the languages with each other only. A text that costs more bits per byte than
    the labelled documents of its language do is in another language, or noise.

    NULL texts and those without a letter are in no language and go; a table without labels teaches nothing,
    so all of it goes. Repeated rows are judged alike, and any column name may occur.
    """
    prepared(spark)
    ppm, limits = Ppm(), Limits()
    halves = gram_counts(docs, ppm)
    most = limits_of_all(docs, halves, ppm, limits)
    rows = numbered_columns(docs)
    text = f"c{docs.columns.index('text')}"
    found = identified(rows, learn_counts(added_up(halves), ppm), text)
    sure = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    sure = sure & plausible(most, limits.lengths, text)
    return found.where(sure).select(*rows.columns).toDF(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return first_of_each_group(docs, SHINGLE_WORDS, MOST_BITS)


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ledger begins empty; a corpus that is updated would keep its folder instead.

    A NULL text stays NULL; repeated rows and those without an id are masked like any other.
    """
    prepared(spark)
    return without_secrets(docs, new_folder(spark, "llm-secret-ledger"), BASE_RULES + MORE_RULES)


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return mixed_documents(docs, Mix())


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``ids`` as little-endian unsigned 32-bit numbers, with their count and the digests.

    A NULL text counts as empty. Other columns than the text and its id are not read.
    """
    prepared(spark)
    return coded(docs, VOCABULARY, with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("near_duplicates", without_near_duplicates),
    ("secret_scan", secrets_masked),
    ("mixing", sources_mixed),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``, each written and read again before the next."""
    docs = documents(spark, sf_dir)
    folder = new_folder(spark, "llm-pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


@registered(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
