import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skyledger import catalog, schemas
from skyledger.operators import joins
from skyledger.sources import bucketed, layout

FIELDS = schemas.FLIGHT_SEARCH_FIELDS


@pytest.fixture(scope="module")
def flights(spark, small):
    return catalog._flights(spark, small)


def touched(path, field, value):
    """Row groups whose bounds for the field hold the value, of all row groups."""
    hit = total = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        place = meta.schema.to_arrow_schema().get_field_index(field)
        for group in range(meta.num_row_groups):
            stats = meta.row_group(group).column(place).statistics
            total += 1
            hit += stats.min <= value <= stats.max
    return hit, total


def test_any_field_prunes(spark, flights, tmp_path):
    """By date alone only the date prunes; in Z-order every field does, and rows stay the same."""
    z, by_date = str(tmp_path / "z"), str(tmp_path / "date")
    layout.write_z_ordered(flights, z, FIELDS, files=256)
    flights.repartitionByRange(256, "FlightDate", "row_key").sortWithinPartitions("FlightDate").write.parquet(by_date)
    some = flights.orderBy(F.xxhash64("row_key")).limit(5).collect()
    share, before = {}, {}
    for field in FIELDS:
        hits = [touched(z, field, row[field]) for row in some]
        share[field] = sum(h for h, _ in hits) / sum(n for _, n in hits)
        old = [touched(by_date, field, row[field]) for row in some]
        if field != "FlightDate":
            before[field] = sum(h for h, _ in old) / sum(n for _, n in old)
        found = spark.read.parquet(z).where(F.col(field) == some[0][field])
        assert found.count() == flights.where(F.col(field) == some[0][field]).count() and f"EqualTo({field}" in found._jdf.queryExecution().toString()
    assert all(part < 0.6 for part in share.values()) and all(share[field] < 0.7 * before[field] for field in before), (share, before)
    assert spark.read.parquet(z).count() == flights.count()


def test_ranks_and_bits(spark):
    df = spark.createDataFrame([(i, None if i == 9 else f"v{i % 4}", i % 2) for i in range(400)], "n int, s string, one int")
    bounds = layout.rank_bounds(df.withColumn("same", F.lit(5)), ("n", "s", "one", "same"), bits=3)
    assert len(bounds["n"]) == 7 and bounds["s"] == ["v1", "v2", "v3"] and bounds["one"] == [1] and bounds["same"] == []
    ranked = df.select("n", layout.rank(F.col("n"), bounds["n"]).alias("r"), layout.rank(F.col("s"), bounds["s"]).alias("s"))
    sizes = [r["count"] for r in ranked.groupBy("r").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * min(sizes)
    assert ranked.where("n = 9").first().s == 0 and ranked.where("n = 3").first().s == 3
    z = spark.range(1).select(layout.interleaved([F.lit(0b101), F.lit(0b011)], bits=3)).first()[0]
    assert z == 0b011011  # from the top: bits 1 and 0, 0 and 1, 1 and 1, the second field's above the first's
    with pytest.raises(ValueError, match="do not fit"):
        layout.interleaved([F.lit(1)] * 9, bits=7)


def test_hot_values_do_not_fill_one_file(spark, tmp_path):
    df = spark.range(5000).select(F.lit("hot").alias("a"), F.lit(1).alias("b"), "id")
    layout.write_z_ordered(df, str(tmp_path / "z"), ("a", "b"), files=8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(str(tmp_path / "z" / "*.parquet"))]
    assert len(sizes) == 8 and max(sizes) < 1500
    layout.write_z_ordered(df.where("id < 0"), str(tmp_path / "none"), ("a", "b"), files=8)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def exchanges(df):
    """Scans with the exchanges and sorts above them, from the executed plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, plan.count("Exchange"), plan.count("Sort ")


def test_bucketed_side_is_neither_moved_nor_sorted(spark, small, tmp_path):
    distances = catalog._distances(spark, small)
    table = bucketed.write(distances, str(tmp_path / "d"), "test_distances", joins.ROUTE_KEY, 4)
    asked = spark.range(50).select("id", F.expr("concat('NATION_', id % 25)").alias("Origin"), F.expr("concat('NATION_', id % 7)").alias("Dest"))
    found = bucketed.joined(asked, table, joins.ROUTE_KEY)
    plan, moves, sorts = exchanges(found)
    assert "SortMergeJoin" in plan and moves == 1 and sorts == 1  # those of the requests
    want = asked.join(distances, joins.ROUTE_KEY, "left")
    assert sorted(map(str, found.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    files = glob.glob(str(tmp_path / "d" / "*.parquet"))
    assert len(files) == 4


def test_both_sides_bucketed_and_opened_again(spark, tmp_path):
    left = spark.range(300).select(F.col("id").cast("string").alias("u"), "id")
    right = spark.range(100, 400).select(F.col("id").cast("string").alias("u"), (F.col("id") * 2).alias("v"))
    bucketed.write(left, str(tmp_path / "l"), "test_left", ["u"], 3)
    b = bucketed.write(right, str(tmp_path / "r"), "test_right", ["u"], 3)
    spark.sql("DROP TABLE test_left")
    a = bucketed.opened(spark, str(tmp_path / "l"), "test_left", "u string, id long", ["u"], 3)
    found = bucketed.joined(a, b, ["u"], "inner")
    plan, moves, sorts = exchanges(found)
    assert moves == 0 and sorts == 0 and found.count() == 200


def test_copies_split_a_hot_key(spark, tmp_path):
    table = spark.createDataFrame([("hot", 1.0), ("cold", 2.0)], "k string, v double")
    copies = bucketed.write(table, str(tmp_path / "c"), "test_copies", ["k"], 4, spread=8)
    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "cold").when(F.col("id") % 10 == 1, "none").otherwise("hot").alias("k"))
    found = bucketed.joined(rows, copies, ["k"])
    assert found.columns == ["k", "id", "v"] and found.count() == 1000
    assert found.where("k = 'none' AND v IS NULL").count() == 100 and found.where("v = 1.0").count() == 800
    shares = found.where("k = 'hot'").groupBy(F.spark_partition_id()).count().count()
    assert shares > 1
