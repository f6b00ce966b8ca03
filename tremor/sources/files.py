"""Batch readers for text and delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.functions.text import decimal_comma, strict_or_null

# Retail export: `;` separated, header line, prices with a decimal comma. All columns
# are declared as text so that the price can be normalised before it is cast.
RETAIL_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice")
RETAIL_SCHEMA = ", ".join(f"{name} STRING" for name in RETAIL_COLUMNS)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in column ``value``; header lines are rows too."""
    return spark.read.text(path)


def raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Comma separated, every column text and named ``_c0``, ``_c1``...; headers are rows."""
    return spark.read.csv(path)


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ";") -> DataFrame:
    """Delimited file with a header line, read with a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("sep", sep).option("header", True).csv(path)


def retail_csv(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """The retail export with typed quantity and price.

    Malformed numbers fail the read; with ``lenient`` they become NULL.
    """
    raw = delimited(spark, path, RETAIL_SCHEMA)
    return raw.withColumns(
        {
            "Quantity": strict_or_null(F.col("Quantity"), "decimal(28,10)", lenient),
            "UnitPrice": decimal_comma(F.col("UnitPrice"), "decimal(28,10)", lenient),
        }
    )
