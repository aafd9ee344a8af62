"""Dependency profiling: functional dependencies, partial dependencies of a
composite key, minimal candidate keys, 2NF decomposition, declared-FD checks.

A few witness rows refute most dependencies and keys for certain; what survives is
evaluated over all rows, in aggregations with ``GROUPING SETS`` (one scan, partial
aggregation map-side). Per group, a
column ``y`` is constant iff ``count(y) = 0`` or (``count(y) = count(*)`` and
``min(y) = max(y)``) when NULL counts as a value, or iff ``count(y) = 0`` or
``min(y) = max(y)`` when NULLs are ignored; no ``count(DISTINCT)`` is needed.
Only combination-sized results (one row per determinant and column) reach the
driver. A pass holds at most ``MAX_SETS_PER_PASS`` grouping sets (the scan's
rows are expanded once per set), so a wide table is profiled in several
passes instead of one pass that multiplies every row by thousands.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.joins import _EXACT
from strata.session import materialize

MAX_SETS_PER_PASS = 32
# Rows that refute dependencies and keys before whole tables are grouped. They only
# spare work: whatever they do not refute is checked on all rows.
WITNESS_ROWS = 20_000
# One of so many groups is looked at first for rows that agree on a combination.
PART_OF_GROUPS = 32
HASHES_PER_TASK = 2_000_000

NULLS_AS_VALUE = "value"  # a NULL is one more value (columnar-frame semantics)
NULLS_IGNORED = "ignore"  # NULL keys dropped, NULL values not counted (pandas semantics)


def _has_order(kind: T.DataType) -> bool:
    """Whether values of a type can be compared: maps cannot, at any depth."""
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _orderable(df: DataFrame) -> list[str]:
    """Columns min/max can compare (what holds a map has no order and is left out)."""
    return [f.name for f in df.schema.fields if _has_order(f.dataType)]


def unprofiled_columns(df: DataFrame) -> list[str]:
    """Columns the dependency profiling leaves out (they hold maps: no order, so no
    min/max and no grouping); reported next to the profiling results."""
    return [f.name for f in df.schema.fields if not _has_order(f.dataType)]


def label(columns: Sequence[str]) -> str:
    """Columns as one text, ``a,b``; a name that holds a comma or backtick is quoted
    by backticks, so that different column lists never look alike."""
    return ",".join("`" + c.replace("`", "``") + "`" if "," in c or "`" in c else c for c in columns)


def _stored_once(df: DataFrame) -> DataFrame:
    """``df``, materialised if more than a scan with filters makes its rows: profiling
    reads them several times."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    made = any(node in plan for node in ("Join ", "Aggregate ", "Generate ", "Window ", "Expand ", "MapIn"))
    return materialize(df, "profiled") if made else df


def _witnesses(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """At most WITNESS_ROWS rows of the named columns, stored: whole groups of equal
    values of each column, chosen by hash, and rows chosen by hash of all columns."""
    kept = df.select(*map(_name, columns))
    share = max(kept.count() * (len(columns) + 1) // WITNESS_ROWS, 1)
    keep = F.pmod(F.xxhash64(*map(_name, columns)), F.lit(share)) == 0
    for c in columns:
        keep = keep | (F.pmod(F.xxhash64(_name(c)), F.lit(share)) == 0)
    return materialize(kept.where(keep).limit(WITNESS_ROWS), "witnesses")


def holding(df: DataFrame, determinants: Sequence[Sequence[str]], targets: Mapping[int, Sequence[str]] | None = None, nulls: str = NULLS_AS_VALUE) -> list[tuple[int, str]]:
    """(number of the determinant, column) of the dependencies that hold.

    A few rows refute most pairs for certain: a group that differs among them differs
    in the table. Only the pairs that survive are grouped over all rows, with no other
    columns, and those in which a determinant is unique cost no more than its groups."""
    dets = [list(d) for d in determinants]
    cols = _orderable(df)
    asked = {i: [c for c in (targets or {}).get(i, cols) if c in cols and c not in d] for i, d in enumerate(dets)}
    needed = [c for c in df.columns if any(c in d for d in dets) or any(c in t for t in asked.values())]
    if not needed:
        return []
    few = _witnesses(df, needed)
    place = {label(d): i for i, d in enumerate(dets)}
    text = frozenset(f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType)))
    # hashes that differ refute; hashes that agree prove nothing here
    refuted = {(place[r["determinant"]], r["dependent"]) for r in _passes(few, dets, asked, nulls, text).where("n_violations > 0").collect()}
    left = {i: [y for y in ys if (i, y) not in refuted] for i, ys in asked.items()}
    left = {i: ys for i, ys in left.items() if ys}
    if not left:
        return []
    return sorted((i, y) for i, ys in left.items() for y in _held(df, dets[i], ys, nulls))


def _held(df: DataFrame, det: list[str], ys: list[str], nulls: str) -> list[str]:
    """The columns of ``ys`` that ``det`` determines, compared by value over all rows.

    Most of them hold, so the distinct rows of these columns, a hash aggregation that
    combines map-side, are about as many as the groups. One row a group proves them
    all; else the distinct rows are compared column by column."""
    kept = df.select(*map(_name, det), *map(_name, ys))
    if nulls == NULLS_IGNORED:
        kept = kept.where(reduce(lambda a, b: a & b, [_name(c).isNotNull() for c in det]))
    distinct = kept.distinct()
    most = distinct.groupBy(*map(_name, det)).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0]
    if (most or 0) <= 1:
        return ys
    return [r["dependent"] for r in _passes(distinct, [det], {0: ys}, nulls).where("n_violations = 0").collect()]


def _text(s: str) -> str:
    """``s`` as a SQL string."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(column: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def _gid(grouping_cols: Sequence[str], group: Sequence[str]) -> int:
    n = len(grouping_cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(grouping_cols) if c not in group)


def constancy(
    df: DataFrame,
    determinants: Sequence[Sequence[str]],
    targets: Mapping[int, Sequence[str]] | None = None,
    nulls: str = NULLS_AS_VALUE,
    max_sets_per_pass: int | None = None,
) -> DataFrame:
    """For each determinant (column list) and target column: number of groups and
    of groups in which the target is not constant.

    Returns (determinant STRING 'a,b', dependent STRING, n_groups BIGINT,
    n_violations BIGINT). ``targets`` maps a determinant's index to its target
    columns (default: every other orderable column).
    """
    dets = [list(d) for d in determinants]
    per_pass = max_sets_per_pass or MAX_SETS_PER_PASS
    text = frozenset(f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType)))
    parts = []
    for lo in range(0, len(dets), per_pass):
        chunk = dets[lo : lo + per_pass]
        sub = None if targets is None else {i - lo: targets[i] for i in range(lo, lo + len(chunk)) if i in targets}
        parts.append(_verified(df, chunk, sub, nulls, text))
    return reduce(DataFrame.unionByName, parts)


def _passes(df: DataFrame, dets: list[list[str]], targets: Mapping[int, Sequence[str]], nulls: str, hashed: frozenset[str] = frozenset()) -> DataFrame:
    """``_constancy_pass`` over at most MAX_SETS_PER_PASS determinants at a time."""
    parts = []
    for lo in range(0, len(dets), MAX_SETS_PER_PASS):
        chunk = dets[lo : lo + MAX_SETS_PER_PASS]
        parts.append(_constancy_pass(df, chunk, {i: targets.get(lo + i, []) for i in range(len(chunk))}, nulls, hashed))
    return reduce(DataFrame.unionByName, parts)


def _verified(df: DataFrame, dets: list[list[str]], targets: Mapping[int, Sequence[str]] | None, nulls: str, text: frozenset[str]) -> DataFrame:
    """One pass by hashes refutes; a text column that survives as constant is
    compared again by its values, on the surviving pairs' columns alone. The
    intermediate result has one row per determinant and column."""
    first = _constancy_pass(df, dets, targets, nulls, text)
    if not text:
        return first
    found = first.collect()
    place = {label(d): i for i, d in enumerate(dets)}
    left: dict[int, list[str]] = {}
    for r in found:
        if r["n_violations"] == 0 and r["dependent"] in text:
            left.setdefault(place[r["determinant"]], []).append(r["dependent"])
    out = {(r["determinant"], r["dependent"]): tuple(r) for r in found}
    if left:
        again = [dets[i] for i in left]
        needed = list(dict.fromkeys(c for i, ys in left.items() for c in [*dets[i], *ys]))
        exact = _constancy_pass(df.select(*map(_name, needed)), again, dict(enumerate(left.values())), nulls)
        out.update({(r["determinant"], r["dependent"]): tuple(r) for r in exact.collect()})
    return df.sparkSession.createDataFrame(list(out.values()), first.schema)


def _constancy_pass(
    df: DataFrame,
    dets: list[list[str]],
    targets: Mapping[int, Sequence[str]] | None,
    nulls: str,
    hashed: frozenset[str] = frozenset(),
) -> DataFrame:
    cols = _orderable(df)
    grouping_cols = list(dict.fromkeys(c for d in dets for c in d))
    tmap = {i: [c for c in (targets or {}).get(i, cols) if c not in d and c in cols] for i, d in enumerate(dets)}
    if not any(tmap.values()):
        return df.sparkSession.createDataFrame([], "determinant string, dependent string, n_groups bigint, n_violations bigint")
    ys = list(dict.fromkeys(c for t in tmap.values() for c in t))
    aggs: list[Column] = [F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__gid")]
    for j, y in enumerate(ys):
        # text is compared by its hash: a fixed-size buffer, so the aggregation hashes
        # instead of sorting the expanded rows; see _verified for equal hashes
        value = F.xxhash64(_name(y)) if y in hashed else _name(y)
        aggs += [F.count(_name(y)).alias(f"__c{j}"), F.min(F.when(_name(y).isNotNull(), value)).alias(f"__mn{j}"), F.max(F.when(_name(y).isNotNull(), value)).alias(f"__mx{j}")]
    grouped = df.groupingSets([[_name(c) for c in d] for d in dets], *map(_name, grouping_cols)).agg(*aggs)

    gids = [_gid(grouping_cols, d) for d in dets]
    if nulls == NULLS_IGNORED:
        # a group whose key has a NULL part is dropped (NULL keys form no group)
        drop = F.lit(False)
        for g, d in zip(gids, dets):
            drop = F.when(F.col("__gid") == g, reduce(lambda a, b: a | b, [_name(c).isNull() for c in d])).otherwise(drop)
        grouped = grouped.filter(~drop)
    flags = []
    for j, _ in enumerate(ys):
        c, mn, mx, n = F.col(f"__c{j}"), F.col(f"__mn{j}"), F.col(f"__mx{j}"), F.col("__n")
        if nulls == NULLS_IGNORED:
            constant = (c == 0) | (mn == mx)
        else:
            constant = (c == 0) | ((c == n) & (mn == mx))
        flags.append(F.sum(F.when(constant, 0).otherwise(1)).alias(f"__v{j}"))
    per_set = grouped.groupBy("__gid").agg(F.count(F.lit(1)).alias("__groups"), *flags)

    rows = []
    for i, (g, d) in enumerate(zip(gids, dets)):
        name = _text(label(d))
        for y in tmap[i]:
            j = ys.index(y)
            rows.append(f"{g}, {name}, {_text(y)}, __v{j}")
    if not rows:
        schema = "determinant string, dependent string, n_groups bigint, n_violations bigint"
        return df.sparkSession.createDataFrame([], schema)
    # per determinant: one row per target (unpivot of the tiny per-set result)
    stacked = per_set.selectExpr(
        "__gid", "__groups", f"stack({len(rows)}, {', '.join(rows)}) AS (__g, determinant, dependent, n_violations)"
    )
    return stacked.filter(F.col("__gid") == F.col("__g")).select(
        "determinant", "dependent", F.col("__groups").cast("bigint").alias("n_groups"), F.col("n_violations").cast("bigint")
    )


def functional_dependencies(df: DataFrame, key_col: str, nulls: str = NULLS_AS_VALUE) -> DataFrame:
    """Columns with at most one value in every group of ``key_col``: (determinant, dependent)."""
    return fd_matrix(df, [key_col], nulls)


def fd_matrix(
    df: DataFrame,
    determinants: Sequence[str] | None = None,
    nulls: str = NULLS_AS_VALUE,
) -> DataFrame:
    """All single-column dependencies ``x -> y`` of the whole table (x in
    ``determinants``, default every column)."""
    dets = list(determinants or _orderable(df))
    found = holding(_stored_once(df), [[c] for c in dets], nulls=nulls)
    return df.sparkSession.createDataFrame([(label([dets[i]]), y) for i, y in found], "determinant string, dependent string")


def declared_fd_check(
    df: DataFrame, declared: Sequence[tuple[str | Sequence[str], Sequence[str]]], nulls: str = NULLS_AS_VALUE
) -> DataFrame:
    """Check declared ``det -> dep1, dep2`` lines: (determinant, dependent, n_groups, n_violations)."""
    dets = [[d] if isinstance(d, str) else list(d) for d, _ in declared]
    targets = {i: list(deps) for i, (_, deps) in enumerate(declared)}
    return constancy(df, dets, targets, nulls)


def declared_fd_violations(
    df: DataFrame, declared: Sequence[tuple[str | Sequence[str], Sequence[str]]], nulls: str = NULLS_AS_VALUE, groups: int = 3
) -> DataFrame:
    """The first ``groups`` violating groups (by key) of each violated declared
    dependency: (determinant, dependent, key, n_rows, samples). ``samples`` are two
    rows of the group that disagree, of its smallest (NULL first) and its largest
    value; key and rows are JSON."""
    broken = {(r["determinant"], r["dependent"]) for r in declared_fd_check(df, declared, nulls).where("n_violations > 0").collect()}
    out = df.sparkSession.createDataFrame([], "determinant string, dependent string, key string, n_rows bigint, samples array<string>")

    def json(columns):
        return F.to_json(F.struct(*map(_name, columns)), {"ignoreNullFields": "false"})

    for det, deps in declared:
        d = [det] if isinstance(det, str) else list(det)
        keys = [f"__k{i}" for i in range(len(d))]
        for y in deps:
            if (label(d), y) not in broken:
                continue
            broken.discard((label(d), y))
            keyed = df.select(*(_name(c).alias(k) for c, k in zip(d, keys)), _name(y).alias("__y"), *map(_name, df.columns))
            differs = F.min("__y") != F.max("__y")
            if nulls == NULLS_IGNORED:
                keyed = keyed.dropna(subset=keys)
            else:
                differs = differs | ((F.count("__y") > 0) & (F.count("__y") < F.count(F.lit(1))))
            first = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), differs.alias("__v")).where("__v").orderBy(*keys).limit(groups)
            few = F.broadcast(first.select(*(F.col(k).alias(f"_{k}") for k in keys), "__n"))
            back = keyed.join(few, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]))
            if nulls == NULLS_IGNORED:
                back = back.where("__y is not null")
            row = json(df.columns)
            rank = F.struct(F.col("__y"), row)  # NULL is the smallest; ties by the row
            out = out.unionByName(
                back.groupBy(*keys).agg(F.first(json(d)).alias("key"), F.first("__n").alias("n_rows"), F.array(F.min_by(row, rank), F.max_by(row, rank)).alias("samples"))
                .select(F.lit(label(d)).alias("determinant"), F.lit(y).alias("dependent"), "key", "n_rows", "samples")
            )
    return out


def parse_declared(lines: Sequence[str]) -> list[tuple[str, list[str]]]:
    """``DET:DEP1,DEP2`` lines (blank lines ignored)."""
    out = []
    for line in lines:
        line = line.strip()
        if line:
            det, right = line.split(":", 1)
            out.append((det.strip(), [d.strip() for d in right.split(",") if d.strip()]))
    return out


def partial_dependencies(df: DataFrame, primary_key: Sequence[str], nulls: str = NULLS_IGNORED) -> DataFrame:
    """Non-key columns determined by a proper, non-empty subset of the key:
    (subset 'a,b', dependent). A column may appear under several subsets."""
    pk = list(primary_key)
    subsets = [list(s) for r in range(1, len(pk)) for s in combinations(pk, r)]
    if not subsets:
        return df.sparkSession.createDataFrame([], "subset string, dependent string")
    others = [c for c in _orderable(df) if c not in pk]
    found = holding(_stored_once(df), subsets, {i: others for i in range(len(subsets))}, nulls)
    return df.sparkSession.createDataFrame([(label(subsets[i]), y) for i, y in found], "subset string, dependent string")


def normalize_2nf(df: DataFrame, primary_key: Sequence[str], nulls: str = NULLS_IGNORED) -> dict[str, DataFrame]:
    """One distinct table per key subset with partial dependencies (subset + its
    columns) and ``main`` with every column used by no subset table (not
    de-duplicated). The dependency list is combination-sized and collected."""
    df = _stored_once(df)
    parts = {label(s): s for r in range(1, len(primary_key)) for s in combinations(primary_key, r)}
    deps: dict[str, list[str]] = {}
    for r in partial_dependencies(df, primary_key, nulls).collect():
        deps.setdefault(r["subset"], []).append(r["dependent"])
    tables: dict[str, DataFrame] = {}
    used: set[str] = set()
    for subset in sorted(deps):
        cols = [c for c in df.columns if c in deps[subset]]
        tables[subset] = df.select(*map(_name, parts[subset]), *map(_name, cols)).distinct()
        used.update(cols)
    tables["main"] = df.select(*[_name(c) for c in df.columns if c not in used])
    return tables


def column_cardinalities(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, int]:
    """Distinct values per column (NULL counted once), ``MAX_SETS_PER_PASS`` columns per job.
    Each column is counted by itself, so that no row is as wide as all of them."""
    cols = list(columns or _orderable(df))
    out: dict[str, int] = {}
    for lo in range(0, len(cols), MAX_SETS_PER_PASS):
        parts = [df.select(_name(c)).distinct().agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("n")) for i, c in enumerate(cols[lo : lo + MAX_SETS_PER_PASS], lo)]
        out.update((cols[r["i"]], int(r["n"])) for r in reduce(DataFrame.unionAll, parts).collect())
    return out


def _key_hash(df: DataFrame, combo: Sequence[str]) -> Column:
    """64 bits of the values of ``combo``, NULLs told apart; equal rows have equal ones."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    # 0.0 and -0.0 are one value
    values = [_name(c) + F.lit(0.0).cast(kinds[c]) if isinstance(kinds[c], (T.FloatType, T.DoubleType)) else _name(c) for c in combo]
    return F.xxhash64(*values, *(_name(c).isNull() for c in combo))


def _repeated_hashes(df: DataFrame, combos: Sequence[Sequence[str]], share: int = 1) -> dict[int, int]:
    """Number of the combination -> the hash of its smallest group of several rows
    (absent: no two rows have equal hashes), of the groups that ``share`` keeps by
    their first column. Only (number, hash) rows are grouped."""
    out: dict[int, int] = {}
    for lo in range(0, len(combos), MAX_SETS_PER_PASS):
        rows = []
        for i, k in enumerate(combos[lo : lo + MAX_SETS_PER_PASS], lo):
            row = F.struct(F.lit(i).alias("i"), _key_hash(df, k).alias("h"))
            rows.append(row if share == 1 else F.when(F.pmod(_key_hash(df, k[:1]), F.lit(share)) == 0, row))
        coded = df.select(F.explode(F.array(*rows)).alias("r")).where("r IS NOT NULL").select("r.i", "r.h")
        if share == 1:  # hardly a hash repeats: dealt at once to tasks of bounded size
            coded = coded.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() * len(rows) // HASHES_PER_TASK)), "i", "h")
        groups = coded.groupBy("i", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        out.update((r["i"], r["h"]) for r in groups.groupBy("i").agg(F.min(F.struct("n", "h")).alias("m")).select("i", "m.h").collect())
    return out


def _unique_combos(df: DataFrame, combos: Sequence[Sequence[str]], max_sets_per_pass: int | None = None) -> list[bool]:
    """Whether no two rows agree on each combination. Rows whose hashes differ are
    different for certain. Where hashes repeat, first among a part of the groups, then
    among all, the rows of one repeated hash are compared by value; only if they
    differ (a collision) is the combination compared by value over all rows."""
    exact = {f.name: isinstance(f.dataType, (*_EXACT, T.FloatType, T.DoubleType)) for f in df.schema.fields}
    out: dict[int, bool] = {}
    for share in (PART_OF_GROUPS, 1):
        open_ = [i for i, k in enumerate(combos) if i not in out and all(exact[c] for c in k)]
        if not open_:
            continue
        repeated = {open_[i]: h for i, h in _repeated_hashes(df, [combos[i] for i in open_], share).items()}
        if share == 1:
            out.update((i, True) for i in open_ if i not in repeated)
        if repeated:
            some = [_key_hash(df, combos[i]) == F.lit(h) for i, h in repeated.items()]
            few = df.where(reduce(lambda a, b: a | b, some))
            unique = _unique_by_value(few, [combos[i] for i in repeated], max_sets_per_pass)
            out.update((i, False) for i, u in zip(repeated, unique) if not u)
    rest = [i for i in range(len(combos)) if i not in out]
    out.update(zip(rest, _unique_by_value(df, [combos[i] for i in rest], max_sets_per_pass) if rest else ()))
    return [out[i] for i in range(len(combos))]


def _unique_by_value(df: DataFrame, combos: Sequence[Sequence[str]], max_sets_per_pass: int | None = None) -> list[bool]:
    per_pass = max_sets_per_pass or MAX_SETS_PER_PASS
    if len(combos) > per_pass:
        out: list[bool] = []
        for lo in range(0, len(combos), per_pass):
            out += _unique_by_value(df, combos[lo : lo + per_pass], per_pass)
        return out
    cols = list(dict.fromkeys(c for k in combos for c in k))
    g = df.groupingSets([[_name(c) for c in k] for k in combos], *map(_name, cols)).agg(
        F.grouping_id().alias("__gid"), F.count(F.lit(1)).alias("__n")
    )
    worst = {r["__gid"]: r["m"] for r in g.groupBy("__gid").agg(F.max("__n").alias("m")).collect()}
    return [worst.get(_gid(cols, k), 0) <= 1 for k in combos]


def candidate_keys(df: DataFrame, max_key_size: int | None = None) -> list[list[str]]:
    """Minimal column combinations with no duplicate rows (NULLs equal), found
    level by level; supersets of a found key are not tested, nor is a
    combination whose product of exact column cardinalities (NULL counted as a
    value) is below the row count, which cannot be unique, nor one on which two of a
    few witness rows agree: the columns on which they agree refute all their subsets
    at once. What is left of a level is one job. Columns are tried in descending cardinality (then name)."""
    df = _stored_once(df)
    cards = column_cardinalities(df)
    n_rows = df.count()
    cols = sorted(cards, key=lambda c: (-cards[c], c))
    found: list[list[str]] = []
    top = len(cols) if max_key_size is None else min(max_key_size, len(cols))
    repeated = _repeats_of(_witnesses(df, cols), cols)

    def may_be_unique(combo: tuple[str, ...]) -> bool:
        product = 1
        for c in combo:
            product *= cards[c]
            if product >= n_rows:
                return True
        return product >= n_rows

    for r in range(1, top + 1):
        combos = [
            list(k)
            for k in combinations(cols, r)
            if not any(set(f) <= set(k) for f in found) and may_be_unique(k) and not repeated(k)
        ]
        if not combos:
            continue
        for combo, ok in zip(combos, _unique_combos(df, combos)):
            if ok:
                found.append(combo)
    return found


def _repeats_of(few: DataFrame, cols: Sequence[str]):
    """``repeated(combination)``: whether two of the witness rows agree on it, so that
    neither it nor any of its subsets is a key. Their values reach the driver as 96
    bits of hashes and a null flag (a bounded table of WITNESS_ROWS rows)."""
    import numpy as np

    value = lambda c: F.concat_ws(":", F.xxhash64(_name(c)).cast("string"), F.hash(_name(c)).cast("string"), _name(c).isNull().cast("string"))
    coded = few.select(*(value(c).alias(f"c{i}") for i, c in enumerate(cols))).toPandas()
    codes = {c: np.unique(coded[f"c{i}"].to_numpy(str), return_inverse=True)[1].astype(np.int64) for i, c in enumerate(cols)} if len(coded) else {}
    agree: list[frozenset] = []  # combinations on which two rows agree

    def repeated(combo: Sequence[str]) -> bool:
        wanted = frozenset(combo)
        if not codes:
            return False
        if any(wanted <= a for a in agree):
            return True
        key = np.zeros(len(coded), np.int64)
        for c in combo:
            key = np.unique(key * (len(coded) + 1) + codes[c], return_inverse=True)[1]
        order = np.argsort(key, kind="stable")
        same = np.flatnonzero(np.diff(key[order]) == 0)
        if not len(same):
            return False
        a, b = order[same[0]], order[same[0] + 1]
        agree.append(frozenset(c for c in cols if codes[c][a] == codes[c][b]))
        return True

    return repeated


def candidate_keys_frame(df: DataFrame, table_name: str, max_key_size: int | None = None) -> DataFrame:
    """``candidate_keys`` as rows (table_name, key_size, key_columns sorted by name)."""
    keys = candidate_keys(df, max_key_size)
    rows = [(table_name, len(k), label(sorted(k))) for k in keys]
    return df.sparkSession.createDataFrame(rows, "table_name string, key_size int, key_columns string")
