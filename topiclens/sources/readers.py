"""Readers. Parquet is the format to use; CSV and text are for exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclens import schemas

# Name of a topic's interest file, and the column that is not a keyword.
INTEREST_FILES = "topic_*_trends.csv"
INTEREST_FILE_TOPIC = r"topic_(\d+)_trends\.csv$"
NOT_A_KEYWORD = "isPartial"
# A cell with the comma before it; a quoted one may hold commas and doubled quotes.
CELL = r',("(?:[^"]|"")*"|[^,]*)'


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Share a table of few file splits among `parts` tasks before costly per-row work.

    Only if the caller asks for it, and alike on every cluster: large tables have splits
    enough, and need no shuffle.
    """
    return df if parts is None else df.repartition(parts, key)


def read_strings_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header; every column is a string.

    `multi_line` is for quoted fields that hold line feeds; such files cannot be split,
    and clean text has none.
    """
    return spark.read.csv(path, header=True, multiLine=multi_line, escape='"')


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType, by_position: bool = True
) -> DataFrame:
    """CSV with a header and a fixed schema, bound by position.

    With `by_position=False` the header names must be those of the schema.
    """
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=by_position, escape='"')


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, schemas.HITS)


def read_binned(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, schemas.BINNED)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    articles = read_strings_csv(spark, path)
    return articles.select(F.col("post_id").cast("long").alias("post_id"), "text")


def read_topic_map(spark: SparkSession, path: str, column: str = "topic_k25") -> DataFrame:
    topics = read_strings_csv(spark, path)
    return topics.select(
        F.col("post_id").cast("long").alias("post_id"), F.col(column).cast("int").alias("topic")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """`post_id, text`: one article per line; its id is its place among the files' splits."""
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("post_id"), F.col("value").alias("text")
    )


def read_term_polarity(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated (term, polarity) without a header; terms may be phrases."""
    return spark.read.csv(path, schema=schemas.TERM_POLARITY, sep="\t", quote="", encoding="UTF-8")


def _unquoted(cell: Column) -> Column:
    inside = F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
    return F.when(cell.startswith('"'), inside).otherwise(cell)


def read_interest_files(spark: SparkSession, folder: str) -> DataFrame:
    """`topic, date, keyword, interest` from one wide CSV per topic, all read at once.

    Each file has columns of its own, so its header line is joined to its rows.
    """
    lines = spark.read.text(folder, pathGlobFilter=INTEREST_FILES).select(
        F.regexp_extract(F.col("_metadata.file_name"), INTEREST_FILE_TOPIC, 1)
        .cast("int")
        .alias("topic"),
        F.transform(
            F.regexp_extract_all(F.concat(F.lit(","), "value"), F.lit(CELL), F.lit(1)), _unquoted
        ).alias("cells"),
    )
    is_header = F.get("cells", F.lit(0)) == "date"
    headers = lines.filter(is_header).select("topic", F.col("cells").alias("names"))
    cells = (
        lines.filter(~is_header)
        .join(headers, "topic")
        .select(
            "topic",
            F.get("cells", F.lit(0)).try_cast("date").alias("date"),
            F.explode(F.arrays_zip("names", "cells")).alias("cell"),
        )
    )
    return cells.filter(~F.col("cell.names").isin("date", NOT_A_KEYWORD)).select(
        "topic",
        "date",
        F.col("cell.names").alias("keyword"),
        F.col("cell.cells").try_cast("double").alias("interest"),
    )
