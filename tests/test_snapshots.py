"""Versioned tables: replacement, UPDATE ... FROM and widening, with failures in between."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quotalake.operators.build import replace_table
from quotalake.sources.snapshots import SnapshotTable, read_widened


@pytest.fixture
def table(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.replace(spark.createDataFrame([(1, 2021, "a"), (2, 2021, "b"), (3, 2022, "c"), (4, None, "d")],
                                    "id int, year int, name string"), ["year"])
    return t


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


START = sorted([(1, 2021, "a"), (2, 2021, "b"), (3, 2022, "c"), (4, None, "d")], key=repr)


def files(df):
    return {f.split("/_data/")[1] for f in df.inputFiles()}


def test_replace_and_read_by_version(spark, table):
    assert rows(table.read()) == START and table.version() == 1
    table.replace(spark.createDataFrame([(9, 2030, "z")], table.schema()), ["year"])
    assert rows(table.read()) == [(9, 2030, "z")]
    assert rows(table.read(version=1)) == START


def test_failed_write_leaves_the_old_rows(spark, table):
    bad = table.read().withColumn("name", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    before = files(table.read())
    for change in (lambda: table.replace(bad, ["year"]), lambda: table.rewrite(bad, ["year=2022", "year=2021"])):
        with pytest.raises(PySparkException):
            change()
        assert rows(table.read()) == START and files(table.read()) == before and table.version() == 1
    spark.range(3).write.parquet(f"{table.path}/_data/v000002-killed")  # what a killed write leaves behind
    assert rows(table.read()) == START
    assert "v000002-killed" in table.drop_old() and rows(table.read()) == START


def test_a_table_may_be_replaced_from_itself(table):
    held = table.read()
    table.replace(table.read().withColumn("id", F.col("id") * 10), ["year"])
    assert rows(table.read()) == sorted(((i * 10, y, n) for i, y, n in START), key=repr)
    assert rows(held) == START  # a reader that came before keeps its version
    table.drop_old()
    assert len(table._children("_data")) == len(table._children("_manifests")) == 1


def test_changes_made_at_the_same_time_are_refused(table):
    base = table.version()
    table.replace(table.read(), ["year"])
    with pytest.raises(RuntimeError, match="same time"):
        table.rewrite(table.read(version=base), ["year=2021", "year=2022", "year=__HIVE_DEFAULT_PARTITION__"], base)


def test_merge_writes_only_partitions_with_a_match(spark, table):
    before = files(table.read())
    changes = spark.createDataFrame([(2, "B"), (77, "nobody"), (None, "null")], "id int, name string")
    assert table.merge(changes, ["id"]) == ["year=2021"]
    assert rows(table.read()) == sorted([(1, 2021, "a"), (2, 2021, "B"), (3, 2022, "c"), (4, None, "d")], key=repr)
    after = files(table.read())
    kept = {f for f in before if "year=2021" not in f}
    assert kept == {f for f in after if "year=2021" not in f} and len(kept) == 2
    assert table.merge(spark.createDataFrame([(99, "x")], "id int, name string"), ["id"]) == []
    assert table.version() == 2


def test_merge_with_partition_keys_sets_nulls_and_inserts(spark, table):
    changes = spark.createDataFrame([(3, 2022, None), (5, 2024, "new"), (1, 2022, "other year")], table.schema())
    assert table.merge(changes, ["id", "year"]) == ["year=2022"]
    assert (3, 2022, None) in rows(table.read()) and len(rows(table.read())) == 4
    assert table.merge(changes, ["id", "year"], insert=True) == ["year=2022", "year=2024"]
    assert rows(table.read()) == sorted([(1, 2021, "a"), (2, 2021, "b"), (3, 2022, None), (4, None, "d"), (5, 2024, "new"),
                                         (1, 2022, "other year")], key=repr)


def test_merge_refuses_what_is_not_defined(spark, table):
    make = spark.createDataFrame
    with pytest.raises(ValueError, match="more than once"):
        table.merge(make([(1, "x"), (1, "y")], "id int, name string"), ["id"])
    with pytest.raises(ValueError, match="cannot be set"):
        table.merge(make([(1, 2023)], "id int, year int"), ["id"])
    with pytest.raises(ValueError, match="cannot be set"):
        table.merge(make([(1, 2023)], "id int, other int"), ["id"])
    assert rows(table.read()) == START


def test_rewrite_can_empty_a_partition_and_refuses_foreign_rows(spark, table):
    with pytest.raises(ValueError, match="other partitions"):
        table.rewrite(table.read(), ["year=2021"])
    table.rewrite(table.read().where("false"), ["year=2021"])
    assert rows(table.read()) == sorted([(3, 2022, "c"), (4, None, "d")], key=repr)
    table.rewrite(table.read().where("false"), table.manifest()["parts"])
    assert rows(table.read()) == [] and table.read().schema == table.schema()


def test_unpartitioned_table_and_pruning(spark, table, tmp_path):
    flat = SnapshotTable(spark, str(tmp_path / "flat"))
    assert not flat.exists()
    with pytest.raises(ValueError, match="no version"):
        flat.read()
    flat.replace(table.read())
    assert flat.merge(spark.createDataFrame([(4, 2025)], "id int, year int"), ["id"]) == [""]
    assert (4, 2025, "d") in rows(flat.read())
    assert len(files(table.read().where("year = 2021"))) >= 1
    plan = table.read().where("year = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_alter_type_widens_without_writing_files(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "money"))
    t.replace(spark.createDataFrame([(1, Decimal("12345678.99")), (2, None)], "id int, target decimal(10,2)"))
    before = files(t.read())
    t.alter_type("target", "decimal(14,2)")
    t.alter_type("id", "bigint")
    assert files(t.read()) == before
    assert t.read().dtypes == [("id", "bigint"), ("target", "decimal(14,2)")]
    assert rows(t.read()) == [(1, Decimal("12345678.99")), (2, None)]
    t.merge(spark.createDataFrame([(1, Decimal("999999999999.99"))], "id bigint, target decimal(14,2)"), ["id"])
    assert rows(t.read()) == [(1, Decimal("999999999999.99")), (2, None)]
    for to in ("decimal(10,2)", "decimal(14,1)", "int", "string"):
        with pytest.raises(ValueError, match="without loss"):
            t.alter_type("target", to)
    with pytest.raises(ValueError, match="no column"):
        t.alter_type("nothing", "int")


def test_files_of_several_widths_give_one_frame(spark, tmp_path):
    path = str(tmp_path / "mixed")
    make = lambda v, p: spark.createDataFrame([(Decimal(v),)], f"target decimal({p},2)")
    make("1.25", 10).write.parquet(path)
    make("999999999999.99", 14).write.mode("append").parquet(path)
    make("3.50", 4).write.mode("append").parquet(path)
    wide = read_widened(spark, path)
    assert wide.dtypes == [("target", "decimal(14,2)")]
    assert sorted(r.target for r in wide.collect()) == [Decimal("1.25"), Decimal("3.50"), Decimal("999999999999.99")]
    assert read_widened(spark, path, StructType.fromDDL("target decimal(16,3)")).count() == 3
    with pytest.raises(PySparkException):
        read_widened(spark, path, StructType.fromDDL("target decimal(10,2)")).collect()
    with pytest.raises(PySparkException, match="loses digits"):
        read_widened(spark, path, StructType.fromDDL("target decimal(14,1)")).collect()
    with pytest.raises(ValueError, match="no file"):
        read_widened(spark, path, StructType.fromDDL("other int"))


def test_replace_table_keeps_the_old_folder_when_the_write_fails(spark, tmp_path):
    path = str(tmp_path / "plain")
    replace_table(spark.range(3), path)
    with pytest.raises(PySparkException):
        replace_table(spark.range(5).withColumn("id", F.raise_error(F.lit("lost")).cast("long")), path)
    assert spark.read.parquet(path).count() == 3
    replace_table(spark.read.parquet(path).where("id > 0"), path)  # from itself
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["plain"]


def test_changes_are_computed_once(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.replace(spark.createDataFrame([(i, 2020 + i % 3, i) for i in range(30)], "id int, year int, v int"), ["year"])
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    changes = spark.createDataFrame([(i, 2020 + i % 3, 100 + i) for i in range(9)], "id int, year int, v int")
    table.merge(changes.mapInArrow(counted, changes.schema), ["id", "year"])
    assert read.value == 9
    assert rows(table.read()) == sorted([(i, 2020 + i % 3, 100 + i if i < 9 else i) for i in range(30)], key=repr)
    assert not [f for f in os.listdir(tmp_path / "t" / "_data") if f.startswith("changes")]
