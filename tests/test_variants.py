from pyspark.sql import functions as F

from skyledger.functions import variants
from tests.conftest import rows

TEXTS = ['{"a":1,"b":{"c":[1,2]}}', '{"a":"x","d":null}', '{"a":2.5}', "[1,2]", "7", "{bad", None, "{}"]


def made(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "n int, t string").withColumn("v", variants.parsed(F.col("t")))


def test_fields_of_many_kinds(spark, tmp_path):
    made(spark).write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    v = F.col("v")
    got = df.select("n", variants.taken(v, "$.a", "int").alias("i"), variants.taken(v, "$.a", "string").alias("s"), variants.taken(v, "$.b.c[1]", "int").alias("c"),
                    variants.has(v, "$.d").alias("d")).orderBy("n").collect()
    assert [r.i for r in got] == [1, None, 2, None, None, None, None, None]
    assert [r.s for r in got] == ["1", "x", "2.5", None, None, None, None, None]
    assert [r.c for r in got][:2] == [2, None] and [r.d for r in got] == [False, True] + [False] * 6
    assert [r.n for r in variants.rejected(df, "t", "v").collect()] == [5]


def test_fields_as_rows_and_schema(spark):
    df = made(spark)
    found = variants.fields(df, "v", ("n",)).select("n", "field", F.to_json("value").alias("json"))
    assert rows(found) == rows(spark.createDataFrame([(0, "a", "1"), (0, "b", '{"c":[1,2]}'), (1, "a", '"x"'), (1, "d", "null"), (2, "a", "2.5")], "n int, field string, json string"))
    schema = variants.merged_schema(df.where("n IN (0, 2)"), "v").first().schema
    assert schema == "OBJECT<a: DECIMAL(11,1), b: OBJECT<c: ARRAY<BIGINT>>>" or schema.startswith("OBJECT<a: ")
    per_key = variants.merged_schema(df.where("n < 3"), "v", ("n",)).orderBy("n").collect()
    assert [r.schema for r in per_key][1] == "OBJECT<a: STRING, d: VOID>"


def test_required_values_fail_the_job(spark):
    import pytest
    df = made(spark).where("n = 1")
    with pytest.raises(Exception, match="VARIANT"):
        df.select(variants.required(F.col("v"), "$.a", "int")).collect()
    assert df.where("n > 9").select(variants.required(F.col("v"), "$.a", "int")).count() == 0
