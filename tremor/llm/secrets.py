"""Secret scans over an incremental ledger of blobs.

Every text, and so every historical version of a file, is addressed by the SHA-256 of its
content. The ledger holds, for each blob, which versions of which rules have scanned it and what
they found. An update scans only the pairs of blob and rule version that the ledger lacks,
appends them, and joins all findings back to every path (here: document) with that content.

The scan is built-in Spark SQL functions throughout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm.common import numbered_columns, stored
from tremor.llm.spans import let, masked, match_spans

LEDGER_SCHEMA = (
    "blob binary, versions array<string>, "
    "found array<struct<start: int, rank: int, kind: string, end: int, version: string>>"
)


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``needs``: literals of which a text holds at least one wherever it matches."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    needs: tuple[str, ...] = ()

    @property
    def version(self) -> str:
        """Changes with anything that changes the findings."""
        parts = (self.kind, self.pattern, str(self.group), str(self.least))
        return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:16]

    def spans(self, text: Column) -> Column:
        none = F.lit(None).cast("array<struct<start: int, end: int>>")
        there = text.rlike(self.pattern)
        if self.needs:
            literal = F.lit(False)
            for part in self.needs:
                literal = literal | text.contains(part)
            there = literal & there
        return F.when(there, match_spans(text, self.pattern, self.group, self.least)).otherwise(none)


# The three base rules, in the order in which they are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        needs=(":", "="),
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}", needs=("AKIA",)),
    Rule("hex", r"[0-9a-f]{24,}"),
)

# What may stand between a key's lines: white space, also as an escape, and marks of quoting.
_BREAK = r"""(?:[\s"'>#*|,]|\\[nr]|\+(?=\s))++"""
#: A private key from its BEGIN to its END. Where the next line of dashes is no END, to the end of its
#: base64 lines, the last of which may be short. Repeats are possessive, so long bodies use no stack.
_PEM = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:"
    r"(?:[^-]++|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_BREAK}(?:Proc-Type:\x20*[0-9]+,[A-Z]+|DEK-Info:\x20*[A-Za-z0-9-]+(?:,[0-9A-Fa-f]+)?))*+"
    rf"""(?:(?:{_BREAK}[A-Za-z0-9+/=]{{20,}}+)++(?:{_BREAK}[A-Za-z0-9+/]++={{0,2}}(?![^\s"'\\,;|]))?)?)"""
)

#: Further kinds, by the public formats of the tokens.
MORE_RULES = (
    Rule("pem", _PEM, needs=("PRIVATE KEY-----",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", needs=("eyJ",)),
    Rule("github", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{60,})", needs=("gh", "github_pat_")),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", needs=("xox",)),
)


def scan(text: Column, missing: Column, rules: tuple[Rule, ...]) -> Column:
    """Findings of those rules whose version is in ``missing``."""
    parts = []
    for rank, rule in enumerate(rules):
        spans = F.when(F.array_contains(missing, rule.version), rule.spans(text))
        none = F.array().cast("array<struct<start: int, end: int>>")
        parts.append(F.transform(F.coalesce(spans, none), _finding(rank, rule)))
    return F.concat(*parts)


def _finding(rank: int, rule: Rule) -> Callable[[Column], Column]:
    return lambda s: F.struct(
        s["start"].alias("start"),
        F.lit(rank).alias("rank"),
        F.lit(rule.kind).alias("kind"),
        s["end"].alias("end"),
        F.lit(rule.version).alias("version"),
    )


#: Addresses of unseen blobs, 32 bytes each, that are sent to every task rather than shuffled with the texts.
BROADCAST_BLOBS = 500_000


def blob_address(text: str) -> Column:
    """The SHA-256 of the content; NULL counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def blob_findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...], text: str = "text") -> DataFrame:
    """``(blob, found)`` of every content of ``docs``, after bringing the ledger folder up to date with them.

    ``found`` is sorted by start and rule. The ledger is a Parquet table that only grows; an
    update that is repeated after a failure finds its pairs scanned already.
    """
    spark = docs.sparkSession
    _new_ledger(spark, ledger)
    versions = F.array(*[F.lit(rule.version) for rule in rules])
    contents = docs.select(blob_address(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = None
    if _ledger(spark, ledger).head(1):
        # Addresses are asked for first; of texts, only those of unseen blobs leave their tasks.
        own = stored(contents.select("blob").distinct(), "secret-addresses")
        held = _ledger(spark, ledger).join(own, "blob", "left_semi")
        seen = held.groupBy("blob").agg(F.flatten(F.collect_list("versions")).alias("seen"))
        missing = F.when(F.col("seen").isNull(), versions).otherwise(F.array_except(versions, F.col("seen")))
        unseen = own.join(seen, "blob", "left").select("blob", missing.alias("versions")).where(F.size("versions") > 0)
        unseen = stored(unseen, "secret-unseen")
        few = unseen.count() <= BROADCAST_BLOBS
        unseen = F.broadcast(unseen) if few else unseen
        contents = contents.join(unseen, "blob")
        wanted = contents.groupBy("blob").agg(F.first("text").alias("text"), F.first("versions").alias("versions"))
    else:
        wanted = contents.groupBy("blob").agg(F.first("text").alias("text")).withColumn("versions", versions)
    scanned = wanted.select("blob", "versions", scan(F.col("text"), F.col("versions"), rules).alias("found"))
    scanned.write.mode("append").parquet(ledger)

    known = _ledger(spark, ledger)
    known = known if own is None else known.join(own, "blob", "left_semi")
    held = known.groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("found"))
    current = F.array_distinct(F.filter("found", lambda f: F.array_contains(versions, f["version"])))
    # Stored, so that a join can split the many paths of a frequent blob.
    return stored(held.select("blob", F.sort_array(current).alias("found")), "secret-findings")


def secret_findings(
    docs: DataFrame, ledger: str, rules: tuple[Rule, ...], text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``(doc_id, blob, found)`` for every row.

    A NULL text counts as empty, a NULL id stays NULL, repeated rows and copies each get the
    findings of their one blob, other columns are not read, and an empty table gives an empty
    result.
    """
    paths = docs.select(F.col(doc_id).alias("doc_id"), blob_address(text).alias("blob"))
    held = blob_findings(docs, ledger, rules, text)
    return paths.join(held, "blob").select("doc_id", "blob", "found")


def without_secrets(docs: DataFrame, ledger: str, rules: tuple[Rule, ...], text: str = "text") -> DataFrame:
    """``docs`` with every secret masked, and ``n_chars``, if there, counted anew where one was."""
    rows = numbered_columns(docs)
    own = f"c{docs.columns.index(text)}"
    held = blob_findings(rows, ledger, rules, own).where(F.size("found") > 0)
    joined = rows.withColumn("own_blob", blob_address(own)).join(held, F.col("own_blob") == F.col("blob"), "left")
    hit = F.col("found").isNotNull()
    made = joined.withColumn(own, F.when(hit, redacted(F.col(own), F.col("found"))).otherwise(F.col(own)))
    if "n_chars" in docs.columns:
        n_chars = f"c{docs.columns.index('n_chars')}"
        counted = F.char_length(own).cast(docs.schema["n_chars"].dataType)
        made = made.withColumn(n_chars, F.when(hit, counted).otherwise(F.col(n_chars)))
    return made.select(*rows.columns).toDF(*docs.columns)


def _new_ledger(spark: SparkSession, folder: str) -> None:
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(folder)


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(folder)


def of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda f: f["kind"] == kind


def listed(found: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    parts = F.transform(
        found,
        lambda f: F.concat(
            f["kind"], F.lit(":"), f["start"].cast("string"), F.lit(":"), f["end"].cast("string")
        ),
    )
    return F.array_join(parts, ",")


def redacted(text: Column, found: Column, mask: str = "[secret]") -> Column:
    """The text with every found secret, or run of overlapping ones, replaced by the mask."""
    spans = F.transform(found, lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end")))
    return let(spans, lambda s: masked(text, s, mask))
