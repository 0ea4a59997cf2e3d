"""Files, day partitions, keyed tables and session helpers."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from skyledger import schemas, session
from skyledger.plans import daily, features
from skyledger.sources import keyed, readers, writers
from tests.conftest import rows


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "out")


def feature_frame(spark, n=20):
    day = dt.date(2017, 3, 5)
    made = [(float(i), dt.datetime(2017, 3, 5, 7, 10), dt.datetime(2017, 3, 5, 6, 30), "HA", 5, 7, 64 - i,
             None if i % 5 == 0 else 14.0, "OGG", 100.0, day, "212", "HNL") for i in range(n)]
    return spark.createDataFrame(made, schemas.TRAINING_FEATURE)


@pytest.mark.parametrize("compression", [None, "bzip2", "gzip"])
def test_feature_files_round_trip(spark, base, compression):
    df = feature_frame(spark)
    features.write(df, base, compression)
    assert rows(readers.json_lines(spark, base, schemas.TRAINING_FEATURE)) == rows(df)
    assert rows(readers.json_text(spark, base, schemas.TRAINING_FEATURE)) == rows(df)
    suffix = {None: ".json", "bzip2": ".bz2", "gzip": ".gz"}[compression]
    assert all(name.endswith(suffix) for name in glob.glob(f"{base}/part-*"))


def test_files_are_in_order_together(spark, base):
    features.write(feature_frame(spark).repartition(4), base, None)
    days = [row.DayOfYear for name in sorted(glob.glob(f"{base}/part-*"))
            for row in readers.json_lines(spark, name, schemas.TRAINING_FEATURE).collect()]
    assert days == sorted(days) and len(days) == feature_frame(spark).count()


def test_inferred_schema(spark, base):
    features.write(feature_frame(spark), base, None)
    inferred = readers.json_lines(spark, base, sampling_ratio=1.0)
    assert set(inferred.columns) == set(schemas.TRAINING_FEATURE.fieldNames())
    assert dict(inferred.dtypes)["DepDelay"] == "double"


def test_offset_dates(spark, base):
    text = ('{"ArrDelay":1.0,"CRSDepTime":"2017-03-05T06:30:00.000-10:00","Carrier":"HA",'
            '"DayOfMonth":5,"FlightDate":"2017-03-04T14:00:00.000-10:00"}')
    spark.createDataFrame([(text,)], "value string").write.text(base)
    row = features.read(spark, base, offset_dates=True).first()
    assert row.FlightDate == dt.date(2017, 3, 5)
    assert row.CRSDepTime == dt.datetime(2017, 3, 5, 16, 30)


def test_parquet_conversion_and_view(spark, base):
    df = feature_frame(spark)
    features.write(df, f"{base}/json", None)
    for _ in range(2):
        writers.json_to_parquet(spark, f"{base}/json", f"{base}/parquet", schemas.TRAINING_FEATURE)
    assert rows(readers.parquet_view(spark, f"{base}/parquet", "converted")) == rows(df)
    assert spark.sql("SELECT count(*) FROM converted").first()[0] == 20


def tasks(spark):
    made = [(f"u{i}", dt.datetime(2016, 12, 25) + dt.timedelta(hours=i * 5), float(i)) for i in range(15)]
    return spark.createDataFrame(made, "UUID string, Timestamp timestamp, DepDelay double")


SCHEMA = schemas.layout(UUID="string", Timestamp="timestamp", DepDelay="double")


def test_days_are_replaced_one_by_one(spark, base):
    daily.fetch_all_requests(tasks(spark), base)
    assert sorted(os.path.basename(p) for p in glob.glob(f"{base}/dt=*")) == [
        "dt=2016-12-25", "dt=2016-12-26", "dt=2016-12-27"]
    one = readers.day_partition(spark, base, SCHEMA, "2016-12-26")
    assert one.count() == 5
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan

    changed = tasks(spark).where("to_date(Timestamp) = '2016-12-26'").withColumn("DepDelay", F.lit(-1.0))
    writers.replace_days(changed.withColumn("dt", F.to_date("Timestamp")), base)
    assert readers.day_partition(spark, base, SCHEMA).count() == 15
    assert {r.DepDelay for r in readers.day_partition(spark, base, SCHEMA, "2016-12-26").collect()} == {-1.0}

    daily.fetch_requests(tasks(spark).where("false"), base, "2016-12-26")
    assert readers.day_partition(spark, base, SCHEMA, "2016-12-26").count() == 0
    assert readers.day_partition(spark, base, SCHEMA).count() == 10


def test_collection_append(spark, base):
    df = tasks(spark)
    for _ in range(2):
        writers.append(df, "parquet", path=base)
    stored = readers.collection(spark, "parquet", path=base).where("DepDelay >= 10")
    assert stored.count() == 10
    assert "GreaterThanOrEqual(DepDelay" in stored._jdf.queryExecution().executedPlan().toString()


def test_topic_options_and_messages(spark):
    assert readers.kafka_options("h:1", "requests", "earliest", 100) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "requests", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "100"}
    df = spark.createDataFrame([("a", None, 1)], "UUID string, Carrier string, DayOfWeek int")
    assert rows(writers.as_messages(df)) == [('{"UUID":"a","DayOfWeek":1}',)]


def test_topic_writer_and_replay(spark):
    writers.write_topic(tasks(spark), "h:1", "responses", fmt="noop")
    with pytest.raises(Exception, match="kafka"):  # no connector is installed here
        readers.topic_replay(spark, "h:1", "requests")


def keyed_rows(spark, *values):
    return spark.createDataFrame(list(values), "uuid string, timestamp string, prediction double")


def test_merged_keeps_old_keys(spark):
    old = keyed_rows(spark, ("a", "2016-01-02", 1.0), ("b", "2016-01-01", 2.0))
    new = keyed_rows(spark, ("a", "2015-01-01", 3.0), ("a", "2015-01-02", 4.0), ("c", None, 0.0))
    want = [("a", "2015-01-02", 4.0), ("b", "2016-01-01", 2.0), ("c", None, 0.0)]
    assert rows(keyed.merged(old, new, ["uuid"], ["timestamp"])) == want
    assert rows(keyed.merged(keyed.merged(old, new, ["uuid"], ["timestamp"]), new, ["uuid"], ["timestamp"])) == want


def test_a_replay_does_not_turn_time_back(spark, base):
    first, second = keyed_rows(spark, ("a", "2024-01-01T00:00", 0.0), ("b", "2024-01-01T00:00", 1.0)), keyed_rows(spark, ("a", "2024-01-01T00:10", 3.0))
    keyed.append(first, base, "first", 0)
    keyed.append(second, base, "second", 0)
    want = [("a", "2024-01-01T00:10", 3.0), ("b", "2024-01-01T00:00", 1.0)]
    assert rows(keyed.responses(spark, base)) == want
    keyed.append(first, base, "first", 0)  # the older batch again, as after a restart
    assert rows(keyed.responses(spark, base)) == want
    keyed.append(keyed_rows(spark, ("a", "2023-12-31T00:00", 9.0), ("c", None, 0.0)), base, "late", 0)
    assert rows(keyed.responses(spark, base)) == [*want, ("c", None, 0.0)]


def test_latest_does_not_depend_on_the_order_of_writes(spark, base):
    writes = [[("a", "t1", 1.0), ("b", "t9", 4.0)], [("a", "t2", 2.0)], [("a", "t2", 5.0), ("b", "t1", 0.0)], [("c", None, 1.0), ("c", "t0", 0.5)]]
    want = [("a", "t2", 5.0), ("b", "t9", 4.0), ("c", "t0", 0.5)]
    for turn, order in enumerate(([0, 1, 2, 3], [3, 2, 1, 0], [2, 0, 3, 1, 2, 0])):
        for batch, write in enumerate(order):
            keyed.append(keyed_rows(spark, *writes[write]), f"{base}/{turn}", f"w{write}", batch)
        assert rows(keyed.responses(spark, f"{base}/{turn}")) == want


def test_compaction_keeps_the_table_and_bounds_reads(spark, base):
    for batch in range(12):
        keyed.append(keyed_rows(spark, ("a", f"t{batch:02}", float(batch)), (f"k{batch}", "t", 0.0)), base, "w", batch)
    before = rows(keyed.responses(spark, base))
    files = len(keyed.responses(spark, base).inputFiles())
    keyed.compact(spark, base, keyed.RESPONSE_KEY, keyed.RESPONSE_ORDER)
    assert rows(keyed.responses(spark, base)) == before and keyed.places(spark, base) == [("compacted", 0)]
    assert len(keyed.responses(spark, base).inputFiles()) <= 4 < files
    keyed.append(keyed_rows(spark, ("a", "t03", 3.0)), base, "w", 3)  # sent again, older than what is there
    keyed.append(keyed_rows(spark, ("a", "t99", 99.0)), base, "w", 12)
    keyed.compact(spark, base, keyed.RESPONSE_KEY, keyed.RESPONSE_ORDER)
    assert keyed.places(spark, base) == [("compacted", 1)] and keyed.responses(spark, base).where("uuid = 'a'").first().prediction == 99.0


def test_interrupted_compaction_changes_nothing(spark, base):
    """The folded place is there, the places it covers are still there too."""
    keyed.append(keyed_rows(spark, ("a", "t1", 1.0)), base, "w", 0)
    keyed.append(keyed_rows(spark, ("a", "t2", 2.0)), base, "w", 1)
    keyed.append(keyed.responses(spark, base), base, keyed.COMPACTED, 0)
    assert rows(keyed.responses(spark, base)) == [("a", "t2", 2.0)] and len(keyed.places(spark, base)) == 3
    keyed.compact(spark, base, keyed.RESPONSE_KEY, keyed.RESPONSE_ORDER)
    assert rows(keyed.responses(spark, base)) == [("a", "t2", 2.0)] and keyed.places(spark, base) == [("compacted", 1)]


def test_distance_imports_add_up(spark, base):
    schema = "Origin string, Dest string, Distance double"
    features.write_distances(spark.createDataFrame([("A", "B", 2139.9), ("C", "D", 10.2)], schema), f"{base}/first")
    features.write_distances(spark.createDataFrame([("A", "B", 5.0), ("A", "B", 7.5)], schema), f"{base}/second")
    features.import_distances(spark, f"{base}/first", f"{base}/v1")
    for _ in range(2):
        got = features.import_distances(spark, f"{base}/second", f"{base}/v2", f"{base}/v1")
        assert rows(got) == [("A", "B", 7), ("C", "D", 10)]
    assert rows(features.read_distances(spark, f"{base}/first")) == [("A", "B", 2139.9), ("C", "D", 10.2)]


def test_response_layout(spark):
    assert keyed.response_rows(spark.createDataFrame([], schemas.STREAM_RESPONSE)).schema == schemas.RESPONSE


def test_work_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = session.work_folder(spark, "x"), session.work_folder(spark, "x")
    assert first != second and first.startswith(shared)


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


def test_work_folder_is_never_on_one_machine():
    class Session:
        conf = _Conf({"spark.sql.warehouse.dir": "hdfs://x/warehouse/"})
    assert session.work_folder(Session(), "n").startswith("hdfs://x/warehouse/_work/skyledger/n-")


def test_counts_are_taken_on_the_way(spark, base):
    """Rows, nulls and whether there was anything to write, without reading a row twice."""
    from pyspark.sql import functions as F
    df = spark.range(100).select("id", F.when(F.col("id") % 4 == 0, F.col("id")).alias("x"), F.lit(None).cast("string").alias("never"))
    rows_, nulls = writers.write_observed(df, lambda out: writers.write_parquet(out, base))
    assert (rows_, nulls) == (100, {"id": 0, "x": 75, "never": 100}) and spark.read.parquet(base).columns == df.columns
    assert writers.write_observed(df.where("id < 0"), lambda out: writers.write_parquet(out, f"{base}/none"), ["x"]) == (0, {"x": 0})


def test_a_folder_of_one_machine_is_refused_on_a_cluster():
    class Session:
        """A session of several machines, as far as ``work_folder`` looks at one."""
        def __init__(self, master, **settings):
            self.conf, self.sparkContext = self, self
            self.master, self.settings = master, settings

        def get(self, key, default=None):
            return self.settings.get(key, default)

    local = {"spark.sql.warehouse.dir": "file:/data/warehouse"}
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.work_folder(Session(master, **local), "x")
        assert session.work_folder(Session(master, **local, **{"spark.checkpoint.dir": "hdfs://n/c"}), "x").startswith("hdfs://n/c/skyledger/x-")
    assert session.work_folder(Session("yarn", **{"spark.sql.warehouse.dir": "s3a://b/w"}), "x").startswith("s3a://b/w/_work/skyledger/x-")
    assert session.work_folder(Session("local[8]", **local), "x").startswith("file:/data/warehouse/_work/")
