"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Columns of a numeric type (pandas ``select_dtypes(include='number')``)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Columns of text type (pandas ``select_dtypes(include='object')``)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def clip(c: Column | str, lo: float | None, hi: float | None) -> Column:
    """Clip to [lo, hi]; null stays null (``least/greatest`` would turn it into a bound)."""
    c = F.col(c) if isinstance(c, str) else c
    out = c
    if lo is not None:
        out = F.when(c < F.lit(lo), F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(c > F.lit(hi), F.lit(hi)).otherwise(out)
    return out.cast("double")


def log10_label(c: Column | str) -> Column:
    """log10 of a positive value; zero, negative and null give null (never -inf)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > 0, F.log10(c.cast("double")))


def inverse_log10(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.pow(F.lit(10.0), c)


def as_float32(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast columns to 32-bit floats (the precision of a float32 model input)."""
    return df.withColumns({c: F.col(c).cast("float") for c in columns})


HASH_RANGE = 1 << 32


def key_hash(*cols: str) -> Column:
    """A stable integer in 0..2^32-1 from the row key (same in any engine or partitioning).

    ``md5`` of the '-'-joined key text, first 8 hex digits read as an integer. Only
    integer and string key columns should be used: the text of a double may differ
    between engines.
    """
    txt = F.concat_ws("-", *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("bigint")


# Text of a number as a form accepts it: no ``NaN``, no ``Infinity``, no type suffix such as ``1d``.
NUMBER_PATTERN = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def strict_number(c: Column | str) -> Column:
    """A finite double from a column of any type, else null (``abc``, ``1d``, NaN, infinity)."""
    c = F.col(f"`{c}`") if isinstance(c, str) else c
    text = F.trim(c.cast("string"))
    return finite(F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double")))


def with_numbers(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with ``{new: column}`` as strict numbers (``strict_number``), each read once per row.

    The text is matched and parsed in one projection and compared with infinity in the next, which refers to the
    parsed value: inside one expression every reference would match and parse again. Doubles and integers
    are numbers already and are not turned into text.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def parsed(name: str) -> Column:
        c = F.col(f"`{name}`")
        if isinstance(types.get(name), (T.DoubleType, T.IntegralType)):
            return c.cast("double")
        text = F.trim(c.cast("string"))
        return F.when(text.rlike(NUMBER_PATTERN), text).try_cast("double")

    df = df.withColumns({new: parsed(name) for new, name in columns.items()})
    return df.withColumns({new: finite(F.col(f"`{new}`")) for new in columns})


def finite(c: Column | str) -> Column:
    """The value as a double; null for NaN and infinity, which summaries leave out."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(F.abs(x) < float("inf"), x)
