"""Expressions on single cells: trimming, blank tests, number parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters the Unicode standard and Python count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Cell texts that count as missing when a delimited text file is read.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Plain decimal or scientific notation, or infinity. Spark's own cast also takes "1d" and
# hexadecimal floats, which are not numbers in a data file.
_NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
_NOT_A_NUMBER = r"^[+-]?[nN][aA][nN]$"


def quoted(name: str) -> str:
    """A column name safe to resolve when it holds dots or other punctuation."""
    return "`" + name.replace("`", "``") + "`"


def cell(name: str) -> Column:
    return F.col(quoted(name))


def stripped(column: Column) -> Column:
    """The cell as text without surrounding white space (tabs and newlines included)."""
    return F.btrim(column.cast("string"), F.lit(WHITE_SPACE))


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.StringType, T.VarcharType, T.CharType))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or not-a-number in a floating point column; never null itself."""
    column = cell(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def parsed_number(df: DataFrame, name: str) -> Column:
    """Double value of a cell, NaN kept; null for missing cells and for text that is no number."""
    if not is_text(df, name):
        return cell(name).cast("double")
    text = stripped(cell(name))
    return F.when(text.rlike(_NUMBER) | text.rlike(_NOT_A_NUMBER), text.try_cast("double"))


def number(df: DataFrame, name: str) -> Column:
    """Double value of a cell; null for anything that is missing, blank or not a number."""
    if not is_text(df, name):
        value = cell(name).cast("double")
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(value), value)
        return value
    text = stripped(cell(name))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def with_parsed(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """The frame with its text columns parsed once, and per name the column of double values.

    Rules that look at a number several times would otherwise parse its text each time.
    """
    helper = {c: f"__parsed_{c}" for c in names if is_text(df, c)}
    wide = df.withColumns({h: parsed_number(df, c) for c, h in helper.items()}) if helper else df
    return wide, {c: cell(helper[c]) if c in helper else parsed_number(df, c) for c in names}


def literal(value: str | int | bool | None) -> str:
    """A value as a SQL literal; whole numbers are bigint."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return f"{value}L"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stacked(columns: Sequence[str], lines: Sequence[Sequence[str]]) -> Column:
    """Turns one row into several: ``lines`` of SQL expressions under the names ``columns``.

    One text instead of a column object per cell, which keeps building wide reports cheap.
    """
    cells = ", ".join(part for line in lines for part in line)
    names = ", ".join(quoted(c) for c in columns)
    return F.expr(f"stack({len(lines)}, {cells}) AS ({names})")
