"""Tables at rest: delimited text at the edges, Parquet between stages."""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnflow.functions.cells import NA_TOKENS, cell, quoted
from churnflow.session import work_folder


def _reading(what: str, path: str, load: Callable[[], DataFrame]) -> DataFrame:
    """Runs a read and reports a missing path as FileNotFoundError naming what was wanted."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"{what} not found: {path}") from error


def require_path(spark: SparkSession, path: str, what: str) -> str:
    """The path itself if a file or folder is there, else FileNotFoundError."""
    _reading(what, path, lambda: spark.read.format("binaryFile").load(path))
    return path


def read_csv(
    spark: SparkSession,
    path: str,
    what: str = "Data",
    na_tokens: Iterable[str] = NA_TOKENS,
    multiline: bool = False,
) -> DataFrame:
    """Delimited files with headers, every column as text and NA tokens as null.

    Types are never guessed: validation sees the cells as written. Cells belong to the names above them: files may have
    their columns in different orders, and a file with other columns fails the read. A row with more cells than its header fails the
    job, unless what is too much is empty; missing cells at its end are null. Cells with line breaks need ``multiline``, which puts
    lines together to records first, by their quotes, many tasks to a file, and returns them in no order; without it a file that has such
    cells is refused.
    """
    options = {"header": True, "inferSchema": False, "escape": '"'}
    names = _reading(what, path, lambda: spark.read.options(**options, multiLine=multiline, enforceSchema=False).csv(path)).columns
    files, orders = _headers(spark, path, what, names, multiline)
    schema = ", ".join(f"{quoted(c)} string" for c in (*names, _SURPLUS))
    if multiline:
        raw = _records(spark, path).select(_FILE, F.from_csv(_RECORD, schema, {"escape": '"'}).alias("r")).select(_FILE, "r.*")
    else:
        raw = spark.read.schema(schema).options(**options, enforceSchema=True).csv(path)
    surplus = F.raise_error(F.concat(F.lit(f"{what} has more cells than its header: "), F.coalesce(cell(names[0]), F.lit("")))).cast("boolean")
    kept = raw.where(F.when(cell(_SURPLUS).isNull(), True).otherwise(surplus))
    if files is None:
        columns = {c: cell(c) for c in names}
    else:
        # Names are those of the first file's places; each file says where a name's cells are in it.
        kept = (kept if multiline else kept.withColumn(_FILE, F.col("_metadata.file_path"))).join(files, _FILE)
        columns = {c: _by_header({header: cell(names[order.index(c)]) for header, order in orders.items()}) for c in names}
    tokens = list(na_tokens)
    return kept.select(*[F.when(~value.isin(tokens), value).alias(c) for c, value in columns.items()])


_SURPLUS, _FILE, _HEADER, _RECORD = "__surplus", "__file", "__header", "__record"
#: Orders of columns that the files of one table have at most.
_ORDERS = 100


def _by_header(values: Mapping[str, Column]) -> Column:
    """The value of the row's header."""
    chosen = F
    for header, value in values.items():
        chosen = chosen.when(F.col(_HEADER) == header, value)
    return chosen


def _headers(
    spark: SparkSession, path: str, what: str, names: Sequence[str], multiline: bool
) -> tuple[DataFrame | None, dict[str, list[str]]]:
    """(file, header) and the columns by header, or None if all files have the same header.

    One pass over the lines finds each file's first one and, unless records may go on over lines, a line with an odd
    number of quotes.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    at_start = (F.col("_metadata.file_block_start") == 0) & (F.trim("value") != "")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias(_FILE), F.when(at_start, F.struct(F.monotonically_increasing_id().alias("at"), "value")).alias("line"),
        (quotes % 2 == 1).alias("odd"))
    files = lines.groupBy(_FILE).agg(F.min("line").alias("line"), F.max("odd").alias("odd"))
    files = stored(files.select(_FILE, F.regexp_replace("line.value", "^\ufeff", "").alias(_HEADER), "odd"), "csv-headers")
    found = files.groupBy(_HEADER).agg(F.max("odd").alias("odd")).where(F.col(_HEADER).isNotNull()).limit(_ORDERS + 1).collect()
    if not multiline and any(r["odd"] for r in found):
        raise ValueError(f"{what} has cells with line breaks; read it with multiline=True")
    if len(found) <= 1:
        return None, {}
    orders = {r[_HEADER]: next(csv.reader([r[_HEADER]])) for r in found}
    wrong = [order for order in orders.values() if sorted(order) != sorted(names)]
    if wrong or len(found) > _ORDERS:
        raise ValueError(f"{what} has files with different columns: {sorted(names)} and {sorted(wrong[0]) if wrong else 'others'}")
    return files.select(_FILE, _HEADER), orders


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record): the records of delimited files, headers left out, where a quoted cell may go on in the next line.

    A line begins a record if an even number of quotes stands before it in its file: those in earlier stretches of the file, from
    one number a stretch, and those before it in its own. Only records of several lines are put together. A
    lone quote inside an unquoted cell would take the lines behind it for one cell; such a record has too many cells, which fails.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value", quotes.alias("quotes"))
    stretches = lines.groupBy(_FILE, "block").agg(F.sum("quotes").alias("quotes"))
    earlier = Window.partitionBy(_FILE).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stretches.select(_FILE, "block", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(_FILE, "block").orderBy("at")
    opened = F.col("before") + F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    judged = lines.join(offsets, [_FILE, "block"]).withColumn("opened", opened % 2).withColumn("open", (F.col("opened") + F.col("quotes")) % 2)
    # A record begins at a line that nothing is open before; blank lines between records are none.
    begins = ((F.col("opened") == 0) & ((F.col("open") == 1) | (F.trim("value") != ""))).cast("int")
    placed = judged.withColumn("begins", begins).withColumn("nth", F.sum("begins").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    totals = judged.groupBy(_FILE, "block").agg(F.sum(begins).alias("held"))
    records_before = totals.select(_FILE, "block", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("records"))
    numbered = placed.join(records_before, [_FILE, "block"]).withColumn("record", F.col("records") + F.col("nth")).where("opened = 1 OR begins = 1")
    # The first record is the header.
    whole = numbered.where("opened = 0 AND open = 0 AND record > 1").select(_FILE, F.col("value").alias(_RECORD))
    lines_of = F.sort_array(F.collect_list(F.struct("block", "at", "value")))
    joined = numbered.where("(opened = 1 OR open = 1) AND record > 1").groupBy(_FILE, "record").agg(
        F.array_join(F.transform(lines_of, lambda x: x.value), "\n").alias(_RECORD))
    return whole.unionByName(joined.select(_FILE, _RECORD))


def read_table(spark: SparkSession, path: str, what: str = "Data") -> DataFrame:
    return _reading(what, path, lambda: spark.read.parquet(path))


def read_processed(
    spark: SparkSession, path: str, target: str, what: str = "Processed data"
) -> DataFrame:
    """A prepared table; the target must be there and becomes an integer."""
    df = read_table(spark, path, what)
    if target not in df.columns:
        raise ValueError(f"{target} target not found in {what.lower()}.")
    return df.withColumn(target, cell(target).cast("int"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself if it has at least one row (no full count)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty.")
    return df


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> str:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows after being written to the shared work folder: later steps don't compute them again."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_table(df: DataFrame, path: str) -> str:
    df.write.mode("append").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """Export with a header row; the number of files follows the partitions."""
    df.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path
