"""Layout by interleaved ranks: what a lookup has to open, and odd values."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import viewmart as vm
from viewmart.operators.interleave import interleaved, rank, rank_borders


def opened(path, column, value):
    """Row groups whose range of a column holds a value, and all row groups."""
    groups = [g for f in sorted(Path(path).glob("*.parquet")) for g in groups_of(f, column)]
    return sum(low <= value <= high for low, high in groups), len(groups)


def groups_of(file, column):
    meta = pq.ParquetFile(file).metadata
    place = meta.schema.names.index(column)
    found = [meta.row_group(g).column(place).statistics for g in range(meta.num_row_groups)]
    return [(s.min, s.max) for s in found]


def facts(spark, pages=256, days=256):
    return spark.range(pages * days).select(
        F.format_string("p%04d", F.col("id") % pages).alias("page_id"),
        F.format_string("d%04d", F.floor(F.col("id") / pages)).alias("date"),
        F.col("id").alias("views"),
    )


def test_lookups_by_either_column_open_few_row_groups(spark, tmp_path):
    rows = facts(spark)
    both, first = str(tmp_path / "both"), str(tmp_path / "first")
    vm.write_interleaved(rows, both, ["page_id", "date"], files=64)
    rows.repartitionByRange(64, "page_id", "date").sortWithinPartitions("page_id", "date").write.parquet(first)
    for column, value in [("page_id", "p0100"), ("date", "d0100")]:
        found, of = opened(both, column, value)
        assert of >= 60 and found <= 20, (column, found, of)
    # an order by page, then day opens all of them for a day
    assert opened(first, "date", "d0100")[0] >= 60
    assert spark.read.parquet(both).exceptAll(rows).isEmpty() and spark.read.parquet(both).count() == 65536


def test_a_value_of_a_third_of_the_rows_spreads_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = facts(spark, 64, 256).withColumn("page_id", F.when(F.col("views") % 3 == 0, "hot").otherwise(F.col("page_id")))
    vm.write_interleaved(rows.withColumn("date", F.lit("d0")), path, ["page_id", "date"], files=16)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in Path(path).glob("*.parquet")]
    assert max(sizes) < 3 * sum(sizes) / 16


def test_bloom_filters_are_written_for_the_named_column(spark, tmp_path):
    path = str(tmp_path / "t")
    # too many long ids for a dictionary
    rows = facts(spark).withColumn("page_id", F.sha2(F.col("views").cast("string"), 256))
    vm.write_interleaved(rows, path, ["page_id", "date"], bloom=["page_id"], files=2)
    file = spark._jvm.org.apache.hadoop.fs.Path(str(next(Path(path).glob("*.parquet"))))
    source = spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(file, spark._jsc.hadoopConfiguration())
    reader = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    columns = list(reader.getFooter().getBlocks()[0].getColumns())
    reader.close()
    assert {c.getPath().toDotString() for c in columns if c.getBloomFilterOffset() > 0} == {"page_id"}


def test_ranks_and_numbers_equal_plain_ones(spark):
    values = [None, -5, 0, 3, 3, 3, 9, 40, 41, 900]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int")
    (borders,) = rank_borders(df, ["v"], bits=3)
    got = [r[0] for r in df.orderBy("i").select(rank(F.col("v"), borders, "int", 3)).collect()]
    assert got == [0 if v is None else sum(int(b) <= v for b in borders) for v in values] and got[-1] == 7
    pair = spark.range(64).select((F.col("id") % 8).cast("int").alias("a"), F.floor(F.col("id") / 8).cast("int").alias("b"))
    for r in pair.select("a", "b", interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect():
        bits = "".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}"))
        assert r.z == int(bits, 2)


def test_odd_values_and_names_come_back(spark, tmp_path):
    schema = "`a.b` string, number double, `row` timestamp_ntz, m map<string,int>"
    rows = [(None, None, None, None), ("", float("nan"), None, {"x": 1}), ("z", -1.5, None, {}), ("z", -1.5, None, {})]
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "t")
    vm.write_interleaved(df, path, ["a.b", "number", "row"])
    back = spark.read.parquet(path)
    assert back.columns == df.columns and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    empty = str(tmp_path / "empty")
    vm.write_interleaved(df.limit(0), empty, ["number"])
    assert spark.read.schema(df.schema).parquet(empty).count() == 0
    with pytest.raises(ValueError):
        vm.interleave(df, [])
