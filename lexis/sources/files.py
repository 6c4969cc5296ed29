"""File sources and sinks: labelled-text CSV, token-list CSV, per-axis
partitioned tables, header-less matrices, report folders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from lexis.session import cut_lineage

POSTS_SCHEMA = Ty.StructType([
    Ty.StructField("person_id", Ty.LongType()), Ty.StructField("type", Ty.StringType()),
    Ty.StructField("posts", Ty.StringType())])

PACKED_SCHEMA = Ty.StructType([
    Ty.StructField("code", Ty.IntegerType()), Ty.StructField("first_person_id", Ty.LongType()),
    Ty.StructField("first_post_no", Ty.LongType()), Ty.StructField("token", Ty.StringType())])

TOKENS_SCHEMA = Ty.StructType([
    Ty.StructField("doc_id", Ty.LongType()), Ty.StructField("label", Ty.IntegerType()),
    Ty.StructField("token", Ty.StringType())])


#: How a NULL is written in CSV; a text that consists of just these two characters is read as NULL.
CSV_NULL = "\\N"


def write_csv(df: DataFrame, path: str, header: bool = True, rows_per_file: int | None = None) -> None:
    """CSV with quoted fields, embedded quotes doubled; an index is an explicit
    column.  Empty texts and NULLs stay different.  ``rows_per_file`` bounds the files."""
    w = df.write.mode("overwrite").option("header", header).option("quote", '"').option("escape", '"') \
        .option("quoteAll", True).option("nullValue", CSV_NULL).option("emptyValue", "") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    (w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w).csv(path)


def _csv_options(header: bool) -> dict:
    return {"header": header, "quote": '"', "escape": '"', "mode": "FAILFAST", "nullValue": CSV_NULL, "emptyValue": "",
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv_by_file(spark: SparkSession, path: str, schema: Ty.StructType, header: bool = True) -> DataFrame:
    """Quoted CSV with multi-line fields and an explicit schema, a task for each file."""
    return spark.read.schema(schema).options(**_csv_options(header)).option("multiLine", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: Ty.StructType, header: bool = True) -> DataFrame:
    """Quoted CSV with multi-line fields and an explicit schema (no inference), a task for
    each split of a file.

    A line begins a record if the file has an even number of quotes before it (quotes
    inside a field are doubled).  One pass counts, for each split, its quotes modulo two
    and the records that begin in it if it is entered outside or inside of a field; a
    prefix sum over the splits of a file says which of the two holds (kept, a row for each
    split).  Each split then puts its own records together, once; only splits that share a
    record with the next are gone through again, to join it from its parts.  Lines end in a
    line feed."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("blk"), F.col("value").alias("line"))
    odd = ((F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))) % 2).cast("int").alias("odd")
    splits = lines.select("file", "blk", odd).mapInArrow(_count_splits, "file string, blk long, parity int, outside long, inside long")
    before = Window.partitionBy("file").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)     # a row for each split
    splits = splits.withColumn("entered", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2)
    begun = F.when(F.col("entered") == 0, F.col("outside")).otherwise(F.col("inside"))
    cut = (F.col("entered") == 1) | ((F.col("entered") + F.col("parity")) % 2 == 1)
    splits = cut_lineage(splits.select(F.col("file").alias("_f"), F.col("blk").alias("_b"), F.col("entered").cast("int").alias("entered"),
                                       F.coalesce(F.sum(begun).over(before), F.lit(0)).alias("first"), cut.alias("_cut")))

    def parts(of: DataFrame) -> DataFrame:
        known = lines.select("file", "blk", "line", odd).join(F.broadcast(of), (F.col("file") == F.col("_f")) & (F.col("blk") == F.col("_b")))
        return known.select("file", "blk", "line", "odd", "entered", "first") \
            .mapInArrow(_put_together, "file string, blk long, record long, text string, whole boolean")
    records = parts(splits).where("whole").select("record", "text")
    if not splits.where("_cut").isEmpty():
        # a record in several splits is one group: its own text
        broken = parts(splits.where("_cut")).where("NOT whole").groupBy("file", "record").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("blk", "text"))), lambda x: x["text"]), "\n").alias("text"))
        records = records.union(broken.select("record", "text"))
    records = records.where("text <> ''")
    if header:
        records = records.where("record > 0")
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _csv_options(False).items()}
    return records.select(F.from_csv("text", schema.simpleString()[len("struct<"):-1].replace(":", " "), options).alias("r")).select("r.*")


def _count_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, blk, odd -> for each split: parity, records begun if entered outside, inside."""
    now, parity, outside, inside = None, 0, 0, 0
    out: list[tuple] = []
    for b in batches:
        for key, i, j in _split_runs(b):
            if key != now:
                out += [(*now, parity, outside, inside)] if now else []
                now, parity, outside, inside = key, 0, 0, 0
            odd = b.column("odd").to_numpy()[i:j]
            state = (parity + np.cumsum(odd) - odd) % 2
            outside, inside = outside + int((state == 0).sum()), inside + int((state == 1).sum())
            parity = int(parity + odd.sum()) % 2
    out += [(*now, parity, outside, inside)] if now else []
    if out:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["file", "blk", "parity", "outside", "inside"])


def _split_runs(b: pa.RecordBatch) -> Iterator[tuple]:
    """``(file, blk), i, j``: the batch's rows by split, in order."""
    if b.num_rows == 0:
        return
    file, blk = b.column("file").dictionary_encode().indices.to_numpy(), b.column("blk").to_numpy()
    cuts = [0, *(np.flatnonzero((np.diff(file) != 0) | (np.diff(blk) != 0)) + 1).tolist(), b.num_rows]
    for i, j in zip(cuts, cuts[1:]):
        yield (b.column("file")[i].as_py(), int(blk[i])), i, j


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits -> their records; what begins or ends in another split is not whole."""
    now, state, record, held, begun = None, 0, -1, [], True
    out: list[tuple] = []

    def close(whole: bool):
        if held:
            out.append((*now, record, "\n".join(held), whole and begun))
    for b in batches:
        for key, i, j in _split_runs(b):
            if key != now:
                close(state == 0)
                now, state, record = key, b.column("entered")[i].as_py(), b.column("first")[i].as_py() - 1
                held, begun = [], False
            if state == 0 and not b.column("odd").to_numpy()[i:j].any():        # every line is a record; the last may go on
                close(True)
                n = j - i
                if n > 1:
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(now[0], pa.string()), n - 1), pa.repeat(pa.scalar(now[1], pa.int64()), n - 1),
                                                      pa.array(np.arange(record + 1, record + n)), b.column("line").slice(i, n - 1).cast(pa.string()),
                                                      pa.repeat(True, n - 1)], ["file", "blk", "record", "text", "whole"])
                record, held, begun = record + n, [b.column("line")[j - 1].as_py()], True
                continue
            for line, odd in zip(b.column("line").slice(i, j - i).to_pylist(), b.column("odd").slice(i, j - i).to_pylist()):
                if state == 0:
                    close(True)
                    record, held, begun = record + 1, [], True
                held.append(line)
                state ^= odd
        if out:
            yield _parts(out)
            out = []
    close(state == 0)
    if out:
        yield _parts(out)


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["file", "blk", "record", "text", "whole"])


def parse_token_list(c) -> F.Column:
    """``"12, 7, 99"`` -> array<int>; an empty string -> empty array."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.trim(col) == "", F.array().cast("array<int>")).otherwise(
        F.transform(F.split(col, ","), lambda x: F.trim(x).cast("int")))


def format_token_list(c) -> F.Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(col.cast("array<string>"), ", ")


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def read_slice(spark: SparkSession, path: str, by: str, value) -> DataFrame:
    """Read one partition value: the filter prunes the other folders."""
    return spark.read.parquet(path).where(F.col(by) == F.lit(value))
