"""Dense surrogate keys without a single-partition sort of unbounded data.

``row_number() OVER (ORDER BY k)`` plans an ``Exchange SinglePartition``: the
whole input goes through one task. Here the batch is first materialised with a
reliable checkpoint and counted (both passes then see identical rows), then:

* a batch of at most ``small_rows`` rows (a proven bound) is numbered by that
  window over its single coalesced partition -- no shuffle at all;
* a larger batch is range-partitioned and sorted within partitions (each
  partition holds a contiguous slice of the global order), tagged with its
  partition id and a per-partition increasing id, checkpointed again, counted
  per partition (one row per partition reaches the driver), and numbered as
  start + rows in earlier partitions + position in its partition.

Both paths give the global ``row_number()`` in ``order_cols`` order (ascending,
NULLs first); the range path does not depend on where the bounds fell.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, set_row_bound
from strata.session import cut_lineage

_PID = "__sk_pid"
_RID = "__sk_rid"

# Largest batch numbered in one task (proven by the count taken first).
SMALL_BATCH_ROWS = 1_000_000


def assign_surrogate_keys(
    df: DataFrame,
    order_cols: Sequence[str],
    id_col: str,
    start: int = 0,
    num_partitions: int | None = None,
    small_rows: int = SMALL_BATCH_ROWS,
    known_max_rows: int | None = None,
) -> DataFrame:
    """Return ``df`` with ``id_col`` = ``start`` + dense 1-based rank in ``order_cols`` order.

    Ties in ``order_cols`` get distinct ids in an unspecified order; pass a
    full tie-break (all columns) for determinism.
    """
    cols = list(df.columns)
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    if known_max_rows is not None and known_max_rows <= small_rows:
        # the caller proves the size and that ``df`` is deterministic (e.g. a
        # filter over checkpointed rows): number it in one task, no extra job
        ranked = df.coalesce(1).select(
            (F.lit(start).cast("bigint") + F.row_number().over(Window.orderBy(*order))).cast("bigint").alias(id_col),
            *cols,
        )
        return set_row_bound(ranked, known_max_rows)
    staged = cut_lineage(df)
    total = staged.count()
    if total <= small_rows:
        ranked = staged.coalesce(1).select(
            (F.lit(start).cast("bigint") + F.row_number().over(Window.orderBy(*order))).cast("bigint").alias(id_col),
            *cols,
        )
        return set_row_bound(ranked, total)
    return _range_keys(staged, cols, order, id_col, start, num_partitions)


def _range_keys(df, cols, order, id_col, start, num_partitions) -> DataFrame:
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    tagged = ranged.sortWithinPartitions(*order).select(
        F.spark_partition_id().alias(_PID),
        F.monotonically_increasing_id().alias(_RID),
        *cols,
    )
    tagged = cut_lineage(tagged)

    stats = (
        tagged.groupBy(_PID)
        .agg(F.count(F.lit(1)).alias("n"), F.min(_RID).alias("first"))
        .collect()  # one row per partition
    )
    if not stats:
        return set_row_bound(tagged.select(F.lit(None).cast("bigint").alias(id_col), *cols).limit(0), 0)
    stats = sorted((r[_PID], r["n"], r["first"]) for r in stats)
    before = [0, *accumulate(n for _, n, _ in stats)][:-1]
    # per partition: id = base + _RID, base = start + rows before - first rid + 1
    width = max(pid for pid, _, _ in stats) + 1
    bases = [0] * width
    for (pid, _n, first), prior in zip(stats, before):
        bases[pid] = start + prior - first + 1
    base = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in bases]), F.col(_PID) + 1)
    out = tagged.select((base + F.col(_RID)).cast("bigint").alias(id_col), *cols)
    total = sum(n for _, n, _ in stats)
    if total <= DEFAULT_BROADCAST_MAX_ROWS:
        # small enough to be broadcast: one partition, one task per later broadcast
        out = out.coalesce(1)
    return set_row_bound(out, total)
