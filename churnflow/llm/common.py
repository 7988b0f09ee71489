"""Helpers that the operators share: their view of a documents table, work tables, checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnflow.session import work_folder

#: Rows of a table that may be broadcast; beyond it the same join shuffles both sides.
BROADCAST_ROWS = 200_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Stands around a match while a text is cut; a text's own copies become U+FFFD, one code point for another.
MARK, INSTEAD = "\ue000", "\ufffd"


def documents_of(documents: DataFrame) -> DataFrame:
    """``doc_id`` as a long and ``text``; whatever other columns a table has stays behind."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def column(name: str) -> Column:
    """The column of this name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def helper(df: DataFrame, name: str) -> str:
    """A name for a column of ours beside all columns of a table, whatever these are called."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def document_key() -> Column:
    """A hash that tells texts of one id apart, as well as documents without an id."""
    doc_id = F.col("doc_id").cast("long")
    return F.xxhash64(doc_id.isNull(), doc_id, F.col("text").cast("string"))


def keyed(documents: DataFrame) -> DataFrame:
    """Adds what tells one document from another: ``doc`` (its id, -1 for none) and ``key`` (a hash of id and text)."""
    return documents_of(documents).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(-1)).alias("doc"),
        document_key().alias("key"),
    )


def marked(documents: DataFrame) -> tuple[DataFrame, str, str]:
    """The table with all its columns, and the names of two more: what ``keyed`` calls ``doc`` and ``key``."""
    doc, key = helper(documents, "doc"), helper(documents, "key")
    return documents.withColumns({doc: F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), key: document_key()}), doc, key


def lowered(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def split_words(text: Column, separators: str) -> Column:
    """The non-empty pieces between runs of separators; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them again, which cuts the lineage."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a table for broadcast if it has at most so many rows; a larger one is joined by shuffling."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the ids that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def by_row_count(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
