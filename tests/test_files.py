"""CSV round trips."""

import random

from lexis.session import scratch_path
from lexis.sources import files as FS
from pyspark.sql import types as Ty


def test_empty_and_null_texts_stay_different(spark):
    rows = [(1, ""), (2, None), (3, 'a "quoted", text\nwith lines'), (4, " "), (5, '""'), (6, "\\"), (7, ",")]
    path = scratch_path(spark, "csv")
    FS.write_csv(spark.createDataFrame(rows, "person_id long, text string").coalesce(1), path, rows_per_file=2)
    schema = Ty.StructType([Ty.StructField("person_id", Ty.LongType()), Ty.StructField("text", Ty.StringType())])
    got = FS.read_csv(spark, path, schema)
    assert sorted(map(tuple, got.collect())) == rows
    assert len(FS.read_csv_by_file(spark, path, schema).inputFiles()) == 4
    assert sorted(map(tuple, FS.read_csv_by_file(spark, path, schema).collect())) == rows


def test_one_file_is_read_by_many_tasks(spark):
    """Records with line feeds, quotes and separators over small splits, equal to the reader of whole files."""
    rnd = random.Random(6)
    bits = ["a,b", '"', '""', "\n", "\n\n", "word ", "é\U0001F600", ',"x"\n', " ", "\t"]
    rows = [(i, rnd.choice([None, "", "".join(rnd.choices(bits, k=rnd.randint(0, 30)))]), rnd.choice(["en", "\n", None])) for i in range(3000)]
    rows += [(5000, 'long "line"\n' * 4000, "spans"), (5001, "after", "it")]                 # longer than several splits
    schema = Ty.StructType([Ty.StructField("doc_id", Ty.LongType()), Ty.StructField("text", Ty.StringType()), Ty.StructField("lang", Ty.StringType())])
    df = spark.createDataFrame(rows, schema)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for header in (True, False):
            path = scratch_path(spark, "csv-split")
            FS.write_csv(df.coalesce(1), path, header=header)
            spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            got = FS.read_csv(spark, path, schema, header=header)
            assert spark.read.text(path).rdd.getNumPartitions() > 20
            assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
            assert sorted(map(tuple, FS.read_csv_by_file(spark, path, schema, header=header).collect()), key=str) == sorted(rows, key=str)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    empty = scratch_path(spark, "csv-empty")
    FS.write_csv(df.limit(0), empty)
    assert FS.read_csv(spark, empty, schema).count() == 0


def test_records_of_one_line_are_put_together_once(spark, monkeypatch):
    """Without a record in two splits each line goes through the parser once, and arrives whole."""
    seen = spark.sparkContext.accumulator(0)
    old = FS._put_together

    def count(batches):
        def each():
            for b in batches:
                seen.add(b.num_rows)
                yield b
        yield from old(each())
    monkeypatch.setattr(FS, "_put_together", count)
    rows = [(i, ", ".join(map(str, range(i % 7)))) for i in range(500)]
    path = scratch_path(spark, "csv")
    FS.write_csv(spark.createDataFrame(rows, "doc_id long, token string").repartition(3), path)
    schema = Ty.StructType([Ty.StructField("doc_id", Ty.LongType()), Ty.StructField("token", Ty.StringType())])
    assert sorted(map(tuple, FS.read_csv(spark, path, schema).collect())) == rows
    assert seen.value == 503


def test_an_open_quote_at_the_end_of_a_file_is_still_read(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([('"1","a"\n"2","b\nc"',), ('"3","d',)], "value string").coalesce(1).write.text(path)
    schema = Ty.StructType([Ty.StructField("doc_id", Ty.LongType()), Ty.StructField("token", Ty.StringType())])
    got = FS.read_csv(spark, path, schema, header=False)
    assert sorted((r[0], r[1].rstrip("\n")) for r in got.collect()) == [(1, "a"), (2, "b\nc"), (3, "d")]
