"""Schema operators: profile/fit, shrink, widen, reconcile, align, date sanitising.

``profile`` computes every column's statistics in one aggregation pass and
reshapes the single result row with ``stack`` inside Spark. ``widen`` is a pure
function on ``DataType``s; ``reconcile`` / ``align`` / ``append_vintages``
evolve a table schema across loads whose columns differ (Spark's own
``unionByName`` would pick a type that fails at run time under ANSI mode).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.exprs import lenient_timestamp, string_size_bucket

# Fixed values that must equal the surveyed workload: integer size thresholds
# (strict "<" on the maximum) and the text size step.
SMALLINT_LIMIT = 32_767
INT_LIMIT = 2_147_483_647
TEXT_SIZE_STEP = 100

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def category(dt: T.DataType) -> str:
    if isinstance(dt, _INTEGRAL):
        return "integer"
    if isinstance(dt, _FRACTIONAL):
        return "float"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dt, T.StringType):
        return "string"
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        return "nested"
    return "other"


def suggested_type(cat: Column, min_v: Column, max_v: Column, max_len: Column) -> Column:
    """Declared type from a column profile (checks both integer bounds; the
    surveyed code checked only the maximum)."""
    fits_small = (min_v.isNull() | (min_v >= -SMALLINT_LIMIT - 1)) & (max_v.isNull() | (max_v < SMALLINT_LIMIT))
    fits_int = (min_v >= -INT_LIMIT - 1) & (max_v < INT_LIMIT)
    int_type = F.when(fits_small, F.lit("SMALLINT")).when(fits_int, F.lit("INT")).otherwise(F.lit("BIGINT"))
    text = F.concat(F.lit("NVARCHAR("), string_size_bucket(max_len).cast("string"), F.lit(")"))
    return (
        F.when(cat == "integer", int_type)
        .when(cat == "float", F.lit("NUMERIC"))
        .when(cat == "date", F.lit("DATE"))
        .when(cat == "datetime", F.lit("DATETIME"))
        .when(cat == "string", text)
        .otherwise(F.lit("NVARCHAR(MAX)"))
    )


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: (column_name, category, min_value, max_value, max_len, suggested).

    ``min_value``/``max_value`` are filled for integer columns, ``max_len`` for
    text columns; all statistics come from a single aggregation over ``df``.
    """
    cols = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs: list[Column] = []
    rows: list[str] = []
    for i, c in enumerate(cols):
        cat = category(types[c])
        mn, mx, ln = "CAST(NULL AS BIGINT)", "CAST(NULL AS BIGINT)", "CAST(NULL AS BIGINT)"
        if cat == "integer":
            aggs += [F.min(c).cast("bigint").alias(f"mn{i}"), F.max(c).cast("bigint").alias(f"mx{i}")]
            mn, mx = f"mn{i}", f"mx{i}"
        elif cat == "string":
            aggs.append(F.max(F.length(c)).cast("bigint").alias(f"ln{i}"))
            ln = f"ln{i}"
        name = c.replace("'", "\\'")
        rows.append(f"'{name}', '{cat}', {mn}, {mx}, {ln}")
    one = df.agg(*aggs) if aggs else df.limit(1).select(F.lit(1).alias("_one"))
    stacked = one.selectExpr(
        f"stack({len(rows)}, {', '.join(rows)}) AS (column_name, category, min_value, max_value, max_len)"
    )
    return stacked.withColumn(
        "suggested",
        suggested_type(F.col("category"), F.col("min_value"), F.col("max_value"), F.col("max_len")),
    )


_SPARK_OF = {"SMALLINT": T.ShortType(), "INT": T.IntegerType(), "BIGINT": T.LongType()}


def fitted_schema(df: DataFrame, columns: Sequence[str] | None = None) -> T.StructType:
    """``df``'s schema with integer columns narrowed to their profiled size
    (the profile result is one row per column, collected to the driver)."""
    prof = {r["column_name"]: r["suggested"] for r in profile(df, columns).collect()}
    fields = []
    for f in df.schema.fields:
        target = _SPARK_OF.get(prof.get(f.name, ""), None)
        fields.append(T.StructField(f.name, target or f.dataType, True))
    return T.StructType(fields)


def shrink(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast integer columns to the narrowest type that holds every value of the whole frame."""
    return align(df, fitted_schema(df, columns))


# ---------------------------------------------------------------------------
# Widening lattice

_RANK = {T.ShortType: 1, T.ByteType: 1, T.IntegerType: 2, T.LongType: 3, T.FloatType: 4, T.DoubleType: 4, T.DecimalType: 4}


def _rank(dt: T.DataType) -> int:
    return _RANK.get(type(dt), 0)


# decimal digits that hold every value of an integer type
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_BINARY = (T.FloatType, T.DoubleType)


def _wider_number(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type for values of both number types: the one that holds them exactly;
    text for a bigint beside a binary fraction, as neither a double nor a decimal
    holds every value of both. Only a decimal beside a binary fraction, or decimals
    that would need more than 38 digits, become a double, which rounds."""
    if _rank(a) < 4 and _rank(b) < 4:
        return b if _rank(b) > _rank(a) else a
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        if isinstance(a, _BINARY) or isinstance(b, _BINARY):
            return T.DoubleType()
        whole, scale = 0, 0
        for t in (a, b):
            digits, s = (t.precision, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0)
            whole, scale = max(whole, digits - s), max(scale, s)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if type(a) is type(b):
        return a
    if T.LongType() in (a, b):
        return T.StringType()
    if T.DoubleType() in (a, b) or T.IntegerType() in (a, b):
        return T.DoubleType()  # a float has too few digits for an int
    return T.FloatType()


def widen(existing: T.DataType, new: T.DataType) -> T.DataType | None:
    """The wider of two column types, or ``None`` when ``existing`` already holds ``new``.

    Equal -> keep; text stays text; anything into text -> text; numeric ranks
    smallint < int < bigint < fractional; two decimals (or a decimal and an
    integer) become the decimal with the larger integer and fraction parts, a
    decimal beside a binary fraction a double, float beside double a double;
    date + timestamp -> timestamp; other mixes -> text.
    """
    if existing == new:
        return None
    if isinstance(existing, T.StringType):
        return None
    if isinstance(new, T.StringType):
        return T.StringType()
    if _rank(existing) and _rank(new):
        wider = _wider_number(existing, new)
        return None if wider == existing else wider
    if isinstance(existing, (T.TimestampType, T.TimestampNTZType)) and isinstance(new, T.DateType):
        return None
    if isinstance(existing, T.DateType) and isinstance(new, (T.TimestampType, T.TimestampNTZType)):
        return new
    return T.StringType()


@dataclass(frozen=True)
class SchemaChange:
    column: str
    action: str  # "add" | "widen"
    data_type: str


def reconcile(stored: T.StructType, new: T.StructType) -> tuple[T.StructType, list[SchemaChange]]:
    """Stored schema evolved by a new load: new columns appended (nullable), types widened."""
    fields = {f.name: f for f in stored.fields}
    order = [f.name for f in stored.fields]
    changes: list[SchemaChange] = []
    for f in new.fields:
        if f.name not in fields:
            fields[f.name] = T.StructField(f.name, f.dataType, True)
            order.append(f.name)
            changes.append(SchemaChange(f.name, "add", f.dataType.simpleString()))
            continue
        wider = widen(fields[f.name].dataType, f.dataType)
        if wider is not None:
            fields[f.name] = T.StructField(f.name, wider, True)
            changes.append(SchemaChange(f.name, "widen", wider.simpleString()))
    return T.StructType([fields[n] for n in order]), changes


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """Reorder to ``target``, cast to its types, NULL-fill missing columns, drop extra ones."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )


def evolve_schema(schemas: Sequence[T.StructType], start: T.StructType | None = None) -> T.StructType:
    return reduce(lambda acc, s: reconcile(acc, s)[0], schemas, start or T.StructType([]))


def append_vintages(frames: Sequence[DataFrame], stored: T.StructType | None = None) -> DataFrame:
    """Union of loads with differing columns: schema evolved over all loads, each aligned, then appended."""
    if not frames:
        raise ValueError("no frames")
    schema = evolve_schema([f.schema for f in frames], stored)
    return reduce(DataFrame.unionByName, [align(f, schema) for f in frames])


# ---------------------------------------------------------------------------
# Date sanitising

DATE_NAME_MARK = "FECHA"


def sanitise_dates(df: DataFrame, mark: str = DATE_NAME_MARK) -> DataFrame:
    """Text columns whose upper-cased name contains ``mark`` become timestamps
    (fraction dropped, lenient parse, NULL when unparsable)."""
    out = []
    for f in df.schema.fields:
        if mark in f.name.upper() and isinstance(f.dataType, T.StringType):
            out.append(lenient_timestamp(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
