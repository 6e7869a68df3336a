import pytest
from pyspark.sql import functions as F, types as T

from tradewind.sources.evolving import EvolvingTable, SchemaConflict, united, widest


@pytest.mark.parametrize("one, other, expected", [
    ("int", "bigint", "bigint"), ("bigint", "smallint", "bigint"), ("int", "decimal(12,2)", "decimal(12,2)"),
    ("bigint", "decimal(12,2)", "decimal(21,2)"), ("decimal(5,4)", "decimal(10,0)", "decimal(14,4)"),
    ("decimal(38,0)", "decimal(38,10)", None), ("float", "double", "double"), ("int", "double", "double"),
    ("smallint", "float", "float"), ("int", "float", "double"), ("bigint", "double", None),
    ("date", "timestamp", "timestamp"), ("string", "int", None), ("array<int>", "array<int>", "array<int>"),
    ("void", "date", "date"), ("decimal(3,1)", "double", None)])
def test_widest(one, other, expected):
    def kind(text):
        return T._parse_datatype_string(f"v {text}")["v"].dataType

    for pair in ((one, other), (other, one)):
        found = widest(*map(kind, pair))
        assert (found.simpleString() if found else None) == expected


def test_three_generations_without_footers(spark, tmp_path):
    table = EvolvingTable(spark, str(tmp_path))
    one = spark.createDataFrame([(1, "a")], "n int, s string")
    two = spark.createDataFrame([(2 ** 40, "b", True)], "N bigint, s string, flag boolean")
    three = spark.sql("SELECT CAST(3.25 AS DECIMAL(12,2)) AS n, false AS flag")
    assert [table.append(rows, f"l{n}") for n, rows in enumerate((one, two, three, one))] == [0, 1, 2, 2]
    assert table.versions()[-1].simpleString() == "struct<n:decimal(21,2),s:string,flag:boolean>"
    found = sorted((float(row["n"]), row["s"], row["flag"]) for row in table.read().collect())
    assert found == [(1.0, "a", None), (1.0, "a", None), (3.25, None, False), (2.0 ** 40, "b", True)]
    plan = table.read()._jdf.queryExecution().toString()
    assert "mergeSchema" not in plan


def test_repeated_and_unfinished_loads(spark, tmp_path, monkeypatch):
    table = EvolvingTable(spark, str(tmp_path))
    table.append(spark.createDataFrame([(1,), (2,)], "n int"), "a")
    table.append(spark.createDataFrame([(2 ** 40,)], "n bigint"), "b")
    table.append(spark.createDataFrame([(5,)], "n int"), "a")  # now under the second version
    assert sorted(row["n"] for row in table.read().collect()) == [5, 2 ** 40]
    # rows without an entry among the loads are a load that died
    spark.createDataFrame([(9,)], "n bigint").write.parquet(f"{tmp_path}/rows/generation=1/_load=c")
    assert sorted(row["n"] for row in table.read().collect()) == [5, 2 ** 40]
    table.append(spark.createDataFrame([(7,)], "n int"), "c")
    assert sorted(row["n"] for row in table.read().collect()) == [5, 7, 2 ** 40]


def test_conflicts_write_nothing(spark, tmp_path):
    table = EvolvingTable(spark, str(tmp_path))
    table.append(spark.createDataFrame([(1, "x")], "n int, load string"), "2024-01-01")
    with pytest.raises(SchemaConflict, match="n: int and string"):
        table.append(spark.createDataFrame([("1",)], "n string"), "2024-01-02")
    assert table.read().collect() == [(1, "x")] and len(table.versions()) == 1
    with pytest.raises(SchemaConflict):
        table.append(spark.createDataFrame([(1,)], "_load int"), "2024-01-02")


def test_empty_loads_void_columns_and_no_load(spark, tmp_path):
    table = EvolvingTable(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.append(spark.createDataFrame([], "n int").withColumn("v", F.lit(None)), "a")
    assert table.read().count() == 0 and table.read().schema["v"].dataType == T.StringType()
    required = T.StructType([T.StructField("n", T.IntegerType(), False)])
    assert united(required, required) == T.StructType([T.StructField("n", T.IntegerType())])
