"""One query per operator, over the whole table it is meant for."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm import oracles
from tremor.llm.bpe import coded
from tremor.llm.common import documents, stored
from tremor.llm.fingerprints import fingerprinted, with_near_counts
from tremor.llm.language_id import Ppm, held_out, identified, learned
from tremor.llm.lm_scoring import Scoring, scored
from tremor.llm.merkle import leaf_digest, proofs, write_manifest
from tremor.llm.mixing import Mix, mix_totals
from tremor.llm.near_dups import near_duplicates
from tremor.llm.pieces import piece_coded
from tremor.llm.quality import LineRules, quality
from tremor.llm.registry import registered
from tremor.llm.secrets import BASE_RULES, MORE_RULES, listed, of_kind, secret_findings
from tremor.llm.sharding import sharded
from tremor.llm.token_files import read_token_files, write_token_files
from tremor.llm.variants import Spelling, variant_groups
from tremor.workspace import new_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@registered()
def op1_simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word shingles, links at 4 or fewer differing bits."""
    found = near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@registered()
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three base rules and four more, from a ledger that begins empty."""
    rules = BASE_RULES + MORE_RULES
    findings = secret_findings(documents(spark, sf_dir), new_folder(spark, "llm-secret-ledger"), rules)
    base = F.filter("found", lambda f: f["rank"] < len(BASE_RULES))
    counts = [
        F.size(F.filter("found", of_kind(rule.kind))).cast("bigint").alias(f"n_{rule.kind}") for rule in BASE_RULES
    ]
    return findings.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans")
    )


@registered()
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 5, 2, 1 over the sources, at most three passes over each."""
    return mix_totals(documents(spark, sf_dir), Mix())


@registered()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the documents that are not held out: remainder 2 of 4 is."""
    docs = documents(spark, sf_dir).withColumn("held_out", held_out("doc_id", 4, 2))
    trees = learned(docs.where("NOT held_out"), Ppm())
    return identified(docs.select("doc_id", "held_out", "text"), trees).drop("text", "bits_per_byte")


@registered()
def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(documents(spark, sf_dir), VOCABULARY)


@registered()
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards whose row counts are at most one apart."""
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(content) + 1).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    placed = sharded(rows, shards=8, seed=3, order=("doc_id", "text_crc32", "size"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@registered()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality(documents(spark, sf_dir).select("doc_id", "text"), LineRules())
    return judged.drop("text", "cleaned")


@registered()
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ``n_near``, the number of other documents whose fingerprint is within four bits."""
    marked = stored(fingerprinted(documents(spark, sf_dir)), "fingerprinted")
    return with_near_counts(marked, radius=4).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fp")).alias("fingerprint"),
        F.lower(F.hex("edited_fp")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_near",
    )


@registered()
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids with the end id 2, written to files and read back."""
    folder = new_folder(spark, "llm-token-files")
    write_token_files(documents(spark, sf_dir), folder, VOCABULARY, end_id=2)
    return read_token_files(spark, folder)


@registered()
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the documents that are not held out: remainder 0 of 10 is."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = scored(docs, ~held_out("doc_id", 10, 0), Scoring())
    return found.withColumn("held_out", ~F.col("trains")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@registered()
def op11_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_coded(documents(spark, sf_dir), PIECES)


@registered(oracles.VARIANTS)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of six characters and five occurrences; a run in 199 loses a letter, as the contract plants it."""
    return variant_groups(documents(spark, sf_dir), Spelling(slips=199))


@registered(oracles.MERKLE)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree per language; a third of the rows are verified with A-Z of their text in lower case."""
    heads = ["doc_id", "source", "lang", "n_chars"]
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = documents(spark, sf_dir).select(
        "doc_id",
        F.col("lang").alias("group"),
        leaf_digest(*heads, "text").alias("leaf"),
        F.when(tampered, leaf_digest(*heads, lowered)).alias("claim"),
    )
    folder = new_folder(spark, "llm-merkle")
    write_manifest(leaves, folder)
    return proofs(spark, folder)
