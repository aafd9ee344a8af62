"""Join helpers: broadcast only behind a measured size bound.

A dimension is broadcast when its rows and bytes, measured on the (already
materialised, small) frame, are under ``max_rows`` and ``MAX_BROADCAST_BYTES``;
free text is measured, not assumed to be short. Beyond a bound a lookup is split
(``split_join``): rows of frequent keys meet a broadcast of those keys' rows, the
others a shuffled join. An anti join beyond it first asks a bitmap of hashed keys
which rows are certainly new; only the others are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import cut_lineage

# Upper bounds of a side that is broadcast: rows, and bytes of its values (a hash
# relation takes about twice as much on the driver and on every executor).
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 << 20
# A key is frequent from this share of the sampled rows, so at most 1000 keys are.
FREQUENT_SHARE, SAMPLE_SHARE = 0.001, 0.01
# Bits of a key bitmap for each existing key, and the most that are broadcast (64 MB).
BITS_PER_KEY, MAX_BITMAP_BITS = 16, 1 << 29
# Bytes counted for a fixed-size value and for a row's own overhead.
_FIXED_BYTES, _ROW_BYTES = 8, 16


# Types whose equal values have equal hashes (not so: collated text, -0.0).
_EXACT = (T.IntegralType, T.DecimalType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

_BOUND_ATTR, _BYTES_ATTR = "_strata_row_bound", "_strata_text_bytes"


def set_row_bound(df: DataFrame, rows: int) -> DataFrame:
    """Record a proven upper bound on the rows of ``df`` (e.g. counted while it was built)."""
    setattr(df, _BOUND_ATTR, int(rows))
    return df


def row_bound(df: DataFrame) -> int | None:
    return getattr(df, _BOUND_ATTR, None)


def keep_row_bound(derived: DataFrame, source: DataFrame) -> DataFrame:
    """``derived`` has no more rows than ``source`` (projection, aggregation, filter)."""
    bound = row_bound(source)
    return set_row_bound(derived, bound) if bound is not None else derived


def is_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (recorded bound, else a
    ``limit(max_rows + 1)`` count, which is recorded only when it is the row
    count, that is when it stays within ``max_rows``)."""
    n = row_bound(df)
    if n is None:
        n = df.limit(max_rows + 1).count()
        if n <= max_rows:
            set_row_bound(df, n)
    return n <= max_rows


def single_partition_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """``coalesce(1)`` a frame with a recorded row bound under ``max_rows``.

    Used on the input of a broadcast side's aggregation: the side is collected
    whole to the driver anyway, and a single partition satisfies the
    aggregation's distribution, so no shuffle stage is planned for it.
    """
    bound = row_bound(df)
    if bound is not None and bound <= max_rows:
        return set_row_bound(df.coalesce(1), bound)
    return df


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` is within both bounds. Its bytes are measured (one aggregation
    over a frame whose rows are within the bound) if it has columns of no fixed size."""
    if not is_bounded(df, max_rows):
        return False
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    free = [f.name for f in df.schema.fields if not isinstance(f.dataType, fixed)]
    size = row_bound(df) * (_ROW_BYTES + _FIXED_BYTES * len(df.columns))
    if size > max_bytes or not free:
        return size <= max_bytes
    held = getattr(df, _BYTES_ATTR, None)
    if held is None:
        texts = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("bigint") for c in free]
        held = df.agg(F.sum(reduce(lambda x, y: x + y, texts))).first()[0] or 0
        setattr(df, _BYTES_ATTR, held)
    return size + held <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if ``df`` is within both bounds, else ``df`` without a hint.

    Uses the recorded row bound when there is one; otherwise counts (at most
    ``max_rows + 1`` rows); text is measured. These are actions: call this on small,
    materialised frames (dimensions, lookup tables), never on a fact.
    """
    if not fits_broadcast(df, max_rows, max_bytes):
        return df
    return keep_row_bound(F.broadcast(df), df)


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def split_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[Column],
    right_keys: Sequence[str],
    share: float = FREQUENT_SHARE,
    sample: float = SAMPLE_SHARE,
    max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Inner equi-join of ``left`` with a ``right`` too large to broadcast.

    Keys that hold at least ``share`` of a sample of ``left`` are frequent: their
    rows of ``right`` are broadcast, if within the bounds, and their rows of ``left``
    are never shuffled, so no task gets a whole hot key. All other rows are joined by
    a shuffle. The sample only decides which way a row goes, the result is that of
    the plain join. NULL keys meet nothing. ``left`` is read twice more (sample and
    second way). The names ``right_keys`` must not occur in ``left``.
    """
    cond = _all(k == right[n] for k, n in zip(left_keys, right_keys))
    names = [f"__hot{i}" for i in range(len(right_keys))]
    keyed = left.sample(fraction=sample, seed=1) if sample < 1 else left
    keyed = keyed.select(*(k.alias(n) for k, n in zip(left_keys, names))).dropna()
    counts = cut_lineage(keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")))
    least = max(2, share * (counts.agg(F.sum("__n")).first()[0] or 0))
    hot = counts.where(F.col("__n") >= least).select(*names)
    few = right.join(F.broadcast(hot), _all(right[k] == F.col(n) for k, n in zip(right_keys, names)), "left_semi")
    if hot.isEmpty() or not fits_broadcast(few, max_rows, max_bytes):
        return left.join(right, cond, "inner")
    by_broadcast = left.join(F.broadcast(few), _all(k == few[n] for k, n in zip(left_keys, right_keys)), "inner")
    rest = left.join(F.broadcast(hot), _all(k == F.col(n) for k, n in zip(left_keys, names)), "left_anti")
    return by_broadcast.unionByName(rest.join(right, cond, "inner"))


def key_bitmap(rows: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(bucket, bitmap): the bits that the hashed keys of ``rows`` set, of ``bits``;
    at most bits / 32768 + 1 rows of 4 KB. Rows with a NULL key part set none."""
    at = F.pmod(F.xxhash64(*keys), F.lit(bits))
    present = rows.select(*keys).dropna().select(at.alias("at"))
    return present.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))


def may_exist(rows: DataFrame, bitmaps: DataFrame, keys: Sequence[str], bits: int, flag: str) -> DataFrame:
    """``rows`` with ``flag``: false if the key is certainly not among those of
    ``bitmaps``. A NULL key part equals nothing: false."""
    at = F.pmod(F.xxhash64(*keys), F.lit(bits))
    side = F.broadcast(bitmaps.select(F.col("bucket").alias("__bucket"), F.col("bitmap").alias("__bitmap")))
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("__bitmap", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1
    known = _all(F.col(k).isNotNull() for k in keys)
    joined = rows.join(side, F.bitmap_bucket_number(at) == F.col("__bucket"), "left")
    return joined.withColumn(flag, F.coalesce(known & is_set, F.lit(False))).drop("__bucket", "__bitmap")


def anti_join(
    new_rows: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Rows of ``new_rows`` whose key has no equal in ``existing`` (``NOT EXISTS``).

    A NULL key part never compares equal, so such rows are always kept, as in
    the correlated ``NOT EXISTS`` this replaces. If the existing keys are too many to
    broadcast, a bitmap of their hashes shows which rows are certainly new; only the
    others are joined, by a shuffle. The key columns must have equal types on both
    sides there, else all rows are joined.
    """
    keys = list(keys)
    right = keep_row_bound(single_partition_if_bounded(existing, max_rows).select(*keys).distinct(), existing)
    if fits_broadcast(right, max_rows):
        return new_rows.join(bounded_broadcast(right, max_rows), on=keys, how="left_anti")
    bound = row_bound(existing)
    bits = 1 << 20
    wanted = BITS_PER_KEY * (existing.count() if bound is None else bound)
    while bits < min(wanted, MAX_BITMAP_BITS):
        bits *= 2
    hashed_alike = all(new_rows.schema[k].dataType == existing.schema[k].dataType and isinstance(new_rows.schema[k].dataType, _EXACT) for k in keys)
    if not hashed_alike:
        return new_rows.join(right, on=keys, how="left_anti")
    bitmaps = cut_lineage(key_bitmap(existing, keys, bits))
    flagged = cut_lineage(may_exist(new_rows, bitmaps, keys, bits, "__may_exist"))
    rest = flagged.where("__may_exist").join(right, on=keys, how="left_anti").select(*new_rows.columns)
    return flagged.where("NOT __may_exist").select(*new_rows.columns).unionByName(rest)
