"""CSV files cut into records in parallel.

A quoted field may span lines, so where a record ends depends on all that stands
before it, in the file. A line acts on one bit, whether a quoted field is open: it
keeps it, flips it, or sets it. Splits of files act on it in the same way, so:

1. every split of every file is scanned once and gives its action on that bit;
2. the bit at the start of each split follows from the actions of the splits before
   it in its file, by running totals over one small row for each split;
3. the splits are scanned again, each from its bit, and give whole records; what
   begins in one split and ends in a later one is joined from its pieces.

No step holds a file, or a split, at once. Lines are cut by the splittable text
reader. A record is as large as it is in the file: one whose quote is never closed
goes on to the end of its file.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.schema import append_vintages
from strata.session import fresh_path

# the scanners travel with the job, so that workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PIECES = "file string, block long, seq long, kind string, record string"


def _line_scanner(sep: str):
    """``open_after(line, open_before)`` for one line without its line feed: a quoted
    field begins at the start of a field only, ``""`` is a quote in it, and what
    stands between its closing quote and the next separator is text."""
    import re

    s = re.escape(sep)
    quoted, rest = re.compile(rf'"(?:[^"]|"")*+"[^{s}]*+'), re.compile(rf'(?:[^"]|"")*+"[^{s}]*+')
    step = len(sep)
    begins = sep + '"'

    def open_after(line: str, open_before: bool) -> bool:
        if '"' not in line:
            return open_before
        if open_before:
            m = rest.match(line)
            if m is None:
                return True
            at = m.end()
        elif line[0] == '"':
            m = quoted.match(line)
            if m is None:
                return True
            at = m.end()
        else:
            at = 0
        while True:
            at = line.find(begins, at)
            if at < 0:
                return False
            m = quoted.match(line, at + step)
            if m is None:
                return True
            at = m.end()

    return open_after


def _lines(spark: SparkSession, paths: Sequence[str], repair) -> DataFrame:
    line = F.regexp_replace("value", "\r+$", "")
    first = F.col("_metadata.file_block_start") == 0
    text = spark.read.option("lineSep", "\n").text(list(paths))
    # a byte order mark can only stand in a file's first line
    plain = F.when(first, F.regexp_replace(line, "^" + chr(0xFEFF), "")).otherwise(line)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), (repair(plain) if repair else plain).alias("line"))


def _actions(lines: DataFrame, sep: str) -> DataFrame:
    """(file, block, closed, open): the bit after each split, by the bit before it."""

    def scan(batches):
        import pandas as pd

        open_after = _line_scanner(sep)
        key, bits, rows = None, (False, True), []
        for pdf in batches:
            for file, block, line in zip(pdf["file"], pdf["block"], pdf["line"]):
                if (file, block) != key:
                    if key is not None:
                        rows.append((*key, *bits))
                    key, bits = (file, block), (False, True)
                if '"' in line:
                    a = open_after(line, bits[0])
                    bits = (a, a if bits[0] == bits[1] else open_after(line, bits[1]))
        if key is not None:
            rows.append((*key, *bits))
        yield pd.DataFrame(rows, columns=["file", "block", "closed", "open"])

    return lines.mapInPandas(scan, "file string, block long, closed boolean, open boolean")


def _open_splits(actions: DataFrame) -> DataFrame:
    """(file, block) of the splits that begin within a quoted field. A split that
    sets the bit makes those before it irrelevant; after the last such one, only the
    number of flips counts."""
    before = Window.partitionBy("file").orderBy("block")
    so_far = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flip = (F.col("closed") & ~F.col("open")).cast("int")
    flips = actions.withColumn("flips", F.sum(flip).over(so_far))
    fixed = F.when(F.col("closed") == F.col("open"), F.col("closed").cast("int") + F.col("flips"))
    after = flips.withColumn("after", F.col("flips") + F.coalesce(F.last(fixed, ignorenulls=True).over(so_far), F.lit(0)))
    return after.withColumn("starts", F.coalesce(F.lag("after").over(before), F.lit(0)) % 2).where("starts = 1").select("file", "block")


def split_records(spark: SparkSession, paths: Sequence[str], sep: str = ",", repair=None) -> DataFrame:
    """(file, block, seq, record) of all files, stored: every non-blank record, with
    the line feeds of its fields. ``repair`` is applied to each line first."""
    lines = _lines(spark, paths, repair)
    # one row a split that begins within a field: its file and offset
    inside = [tuple(r) for r in _open_splits(_actions(lines, sep)).collect()]
    shared = spark.sparkContext.broadcast(frozenset(inside))

    def scan(batches):
        import pandas as pd

        open_after = _line_scanner(sep)
        key, bit, head, held, seq, out, size = None, False, False, [], 0, [], 0

        def end_split():
            # what is open goes on in the next split; a head that never ended is passed through
            if held:
                out.append((*key, seq, "through" if head else "tail", "\n".join(held)))

        def frame():
            made = pd.DataFrame(out, columns=["file", "block", "seq", "kind", "record"])
            out.clear()
            return made

        for pdf in batches:
            for file, block, line in zip(pdf["file"], pdf["block"], pdf["line"]):
                if (file, block) != key:
                    if key is not None:
                        end_split()
                    key, held, seq = (file, block), [], 0
                    bit = head = key in shared.value
                bit = open_after(line, bit)
                held.append(line)
                if bit:
                    continue
                record = held[0] if len(held) == 1 else "\n".join(held)
                if head or record.strip():
                    out.append((file, block, seq, "head" if head else "whole", record))
                    size += len(record)
                held, head, seq = [], False, seq + 1
            if size > 1 << 22:
                yield frame()
                size = 0
        if key is not None:
            end_split()
        yield frame()

    pieces = _stored(lines.mapInPandas(scan, _PIECES), "csv-pieces")
    whole = pieces.where("kind = 'whole'").select("file", "block", "seq", "record")
    broken = pieces.where("kind <> 'whole'")
    if not inside:  # a record left open at the end of its file is all there can be
        return whole.unionByName(broken.select("file", "block", "seq", "record"))
    order = Window.partitionBy("file").orderBy("block", "seq")
    broken = broken.withColumn("chain", F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "record")))
    joined = broken.groupBy("file", "chain").agg(parts.alias("p")).select(
        "file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["seq"].alias("seq"), F.array_join(F.col("p.record"), "\n").alias("record")
    )
    return whole.unionByName(joined)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def header_names(record: str, sep: str) -> list[str]:
    """Column names of a header record: blank ones are named by position, equal ones
    (whatever their case) get their position behind them."""
    names = next(csv.reader(io.StringIO(record, newline=""), delimiter=sep), [])
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(lower[i]) > 1 else n for i, n in enumerate(names)]


def _csv_of(records: DataFrame, reader) -> DataFrame:
    """Records (one string column) through Spark's CSV reader."""
    spark = records.sparkSession
    texts = getattr(records._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(reader._jreader.csv(texts), spark)


def _reader(spark: SparkSession, sep: str):
    return (
        spark.read.option("header", False).option("sep", sep).option("quote", '"').option("escape", '"')
        .option("multiLine", True).option("mode", "PERMISSIVE").option("maxCharsPerColumn", -1)
    )


def _typed(names: list[str], schema: T.StructType) -> T.StructType:
    """``schema`` in the order of a file's header: by name, or by place if the header
    names other columns but as many."""
    by_name = {f.name: f for f in schema.fields}
    if set(names) <= set(by_name):
        return T.StructType([by_name[n] for n in names])
    if len(names) != len(schema.fields):
        raise ValueError(f"header {names} does not fit the schema {schema.names}")
    return T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, schema.fields)])


def read_records(
    spark: SparkSession, paths: Sequence[str], sep: str = ",", schema: T.StructType | None = None, infer: bool = True,
    corrupt_column: str | None = None, repair=None,
) -> DataFrame:
    """CSV files with header records as one frame.

    Every file is read by its own header; files of equal headers are one scan, and
    those whose columns differ are aligned by name and widened like any vintages.
    Types come from all records unless ``schema`` gives them or ``infer`` is false
    (text). A record equal to the header stays if it is not its file's first one.
    Empty files give nothing."""
    records = split_records(spark, paths, sep, repair)
    firsts = records.groupBy("file").agg(F.min(F.struct("block", "seq", "record")).alias("first"))
    heads = [(r["file"], r["first"]["block"], r["first"]["seq"], r["first"]["record"]) for r in firsts.collect()]  # one row a file
    if not heads:
        return spark.createDataFrame([], schema or T.StructType([]))
    distinct = sorted({h[3] for h in heads})
    # one row a file: with its header's number and the place of that record
    numbered = spark.createDataFrame([(f, b, s, distinct.index(h)) for f, b, s, h in heads], "file string, hblock long, hseq long, header int")
    body = records.join(F.broadcast(numbered), "file").where("block <> hblock OR seq <> hseq")
    frames = []
    for i, head in enumerate(distinct):
        names = header_names(head, sep)
        own = body.where(F.col("header") == i).select("record")
        if schema is not None:
            kinds = _typed(names, schema)
        else:
            kinds = T.StructType([T.StructField(n, T.StringType()) for n in names])
            if infer:
                found = _csv_of(own, _reader(spark, sep).option("inferSchema", True).option("samplingRatio", 1.0)).schema
                # records may have fewer or more fields than the header
                kinds = T.StructType([T.StructField(n, found[k].dataType if k < len(found) else T.StringType()) for k, n in enumerate(names)])
        reader = _reader(spark, sep)
        if corrupt_column:
            kinds = T.StructType([*kinds.fields, T.StructField(corrupt_column, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        frames.append(_csv_of(own, reader.schema(kinds)))
    return frames[0] if len(frames) == 1 else append_vintages(frames)
