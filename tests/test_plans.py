"""Features, requests, models and the daily chain."""

import datetime as dt
import random

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions.text import DELAY_CLASSES_3
from skyledger.operators import aggregates, ordering
from skyledger.plans import daily, encoding, features, forest_table, requests, scoring, training
from skyledger.sources import readers
from tests.conftest import rows

FLIGHT = dict(FlightNum="212", FlightDate="2016-12-31", DayOfWeek=6, DayofMonth=31, Month=12, Carrier="HA", Origin="HNL",
              Dest="OGG", Distance=100.0, DepDelay=3.0, ArrDelay=1.0, CRSDepTime="0630", CRSArrTime="0710")
TYPES = dict(DayOfWeek="int", DayofMonth="int", Month="int", Distance="double", DepDelay="double", ArrDelay="double")


def frame(spark, *changes):
    made = [{**FLIGHT, **change} for change in changes]
    schema = ", ".join(f"{name} {TYPES.get(name, 'string')}" for name in FLIGHT)
    return spark.createDataFrame([tuple(row[name] for name in FLIGHT) for row in made], schema)


def test_extract_example(spark):
    row = features.extract(frame(spark, {})).first()
    assert row.asDict() == dict(
        FlightNum="212", FlightDate=dt.date(2016, 12, 31), DayOfWeek=6, DayOfMonth=31, DayOfYear=366, Carrier="HA",
        Origin="HNL", Dest="OGG", Distance=100.0, DepDelay=3.0, ArrDelay=1.0,
        CRSDepTime=dt.datetime(2016, 12, 31, 6, 30), CRSArrTime=dt.datetime(2016, 12, 31, 7, 10))


def test_extract_splits_good_and_bad(spark):
    df = frame(spark, {}, {"ArrDelay": None}, {"DepDelay": None}, {"CRSDepTime": "9999"}, {"FlightDate": "bad"},
               {"CRSArrTime": None}, {"DayOfWeek": None}, {"CRSArrTime": "2400"}, {"CRSDepTime": "2310", "CRSArrTime": "0010"})
    good, bad = features.extract(df).collect(), features.rejects(df).collect()
    assert len(good) == 3 and len(bad) == 4
    assert good[1].CRSArrTime == dt.datetime(2016, 12, 31, 23, 59)
    assert good[2].CRSArrTime == dt.datetime(2017, 1, 1, 0, 10)
    assert {r.CRSDepTime for r in bad} == {"9999", "0630"}


def test_null_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "flights")
    frame(spark, {}, {"ArrDelay": None}).write.parquet(path)
    plan = features.extract(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(ArrDelay)" in plan and "IsNotNull(DepDelay)" in plan
    assert "Month" not in plan.split("ReadSchema")[1].replace("DayofMonth", "")


def test_distances(spark):
    df = frame(spark, {"Distance": 10.0}, {"Distance": 20.0}, {"Origin": "ATL", "Distance": 5.0})
    assert [tuple(r) for r in features.distances(df).collect()] == [("ATL", "OGG", 5.0), ("HNL", "OGG", 15.0)]
    assert [r.Distance for r in features.distances(df, descending=True).distinct().orderBy("Distance").collect()] == [5.0, 15.0]


FORMS = [("5", "AA", "2016-12-25", "SFO", "1519", "ATL"), ("abc", "AA", "2016-12-25", "XXX", "1", "ATL"),
         ("1.5", "AA", "nonsense", "SFO", "2", "ATL"), (None, None, None, None, None, None)]


def raw(spark):
    return spark.createDataFrame(FORMS, "DepDelay string, Carrier string, FlightDate string, Dest string, FlightNum string, Origin string")


@pytest.fixture(scope="module")
def distance_frame(spark):
    return spark.createDataFrame([("ATL", "SFO", 2139.5)], "Origin string, Dest string, Distance double")


def test_requests(spark, distance_frame):
    made = requests.realtime_requests(raw(spark), distance_frame, as_of="2016-12-20T18:06:45.307114")
    got = {r.FlightNum: r for r in made.collect()}
    first = got["1519"]
    assert (first.DepDelay, first.Distance, first.DayOfYear, first.DayOfMonth, first.DayOfWeek) == (5.0, 2139.5, 360, 25, 7)
    assert first.Timestamp == "2016-12-20T18:06:45.307114" and len({r.UUID for r in got.values()}) == 4
    assert (got["1"].DepDelay, got["1"].Distance) == (None, 0.0)
    assert (got["2"].DayOfYear, got["2"].DepDelay) == (None, 1.5)
    assert got[None].Distance == 0.0


def test_request_variants(spark, distance_frame):
    batch = requests.batch_requests(raw(spark), distance_frame, numbering="weekday0", integer_distance=True, as_of="t")
    assert "UUID" not in batch.columns
    row = batch.where("FlightNum = '1519'").first()
    assert (row.DayOfWeek, row.Distance) == (6, 2139)
    assert requests.batch_requests(raw(spark), distance_frame, missing="drop", as_of="t").count() == 2
    whole = requests.regression_requests(raw(spark), distance_frame, as_of="t")
    assert {r.FlightNum: r.DepDelay for r in whole.collect()} == {"1519": 5, "1": None, "2": None, None: None}


# --- models -----------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def sample(spark):
    pick = random.Random(1)
    made = []
    for i in range(1500):
        delay = float(pick.randrange(-40, 90))
        made.append({"DepDelay": delay, "ArrDelay": delay + pick.randrange(-3, 3), "Carrier": pick.choice(["AA", "DL", "WN"]),
                     "Origin": pick.choice(["ATL", "SFO"]), "Dest": pick.choice(["SAN", "ORD", "JFK"]), "FlightNum": str(i % 50)})
    return features.extract(frame(spark, *made)).cache()


@pytest.fixture(scope="module")
def trained(sample):
    return training.train(sample, seed=3)


def test_bucket_bounds(spark):
    assert spark.range(1).select(aggregates.bucket_delay(F.lit(float("nan")))).first()[0] is None
    delays = [-100.0, -15.1, -15.0, -0.1, 0.0, 29.9, 30.0, 500.0, None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(delays)], "i int, ArrDelay double")
    both = training.delay_bucketizer().transform(df).withColumn("expr", aggregates.bucket_delay(F.col("ArrDelay")))
    got = both.orderBy("i").collect()
    assert [r[training.LABEL] for r in got] == [0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0, None] == [r.expr for r in got]


def test_indexers_equal_the_built_in_one(spark):
    df = spark.createDataFrame([(a, b) for a, b in zip("bbaaccdz", "xxxyyzzz")] + [(None, "x")], "a string, b string")
    ours = training.label_index(df, ["a", "b"]).collect()
    built_in = StringIndexer(inputCols=["a", "b"], outputCols=["a_index", "b_index"], handleInvalid="skip").fit(df)
    for name, labels in zip(["a", "b"], built_in.labelsArray):
        assert [(r.label, r["index"]) for r in sorted(ours, key=lambda r: r["index"]) if r.column_name == name] == [(x, float(n)) for n, x in enumerate(labels)]


def test_many_labels(spark):
    df = spark.range(20_000).select(F.concat(F.lit("x"), F.col("id") % 7000).alias("a"))
    got = {r.label: (r.rows, int(r["index"])) for r in training.label_index(df, ["a"]).collect()}
    order = sorted(got, key=lambda label: (-got[label][0], label))
    assert [got[label][1] for label in order] == list(range(7000))
    assert training.label_index(df.limit(0), ["a"]).count() == 0


def test_hashed_column(sample):
    trained = training.train(sample, hashed={"Route": 8})
    assert trained.accuracy() > 0.8 and "Route" not in trained.model.sizes
    assert scoring.score(sample.limit(5), trained.model).count() == 5


def test_training(sample, trained):
    assert trained.accuracy() > 0.8
    scored = scoring.score(sample, trained.model)
    assert set(scored.columns) == {*sample.columns, "Route", "Prediction"}
    assert scored.count() == sample.count()
    assert rows(aggregates.distribution(scored, "Prediction")) == rows(trained.distribution().select("Prediction", "count"))
    labelled = training.delay_bucketizer().transform(scored)
    assert training.evaluate(labelled) == pytest.approx(trained.accuracy())
    by_rows = aggregates.accuracy(labelled, training.LABEL, "Prediction").first()[0]
    assert by_rows == pytest.approx(trained.accuracy())


def test_holdout(sample):
    late = sample.where("DepDelay > 60")
    assert training.train(sample, seed=3, holdout=late).confusion.agg(F.sum("rows")).first()[0] == late.count()


def test_round_trip(spark, sample, trained, tmp_path):
    path = str(tmp_path / "model")
    for _ in range(2):
        training.save(trained.model, path)
    again = training.load(spark, path)
    pick = ["FlightNum", "DepDelay", "Carrier", "Route", "Prediction"]
    assert rows(scoring.score(sample, again).select(*pick)) == rows(scoring.score(sample, trained.model).select(*pick))
    assert training.load_bucketizer(spark, path).getSplits() == training.DELAY_SPLITS


def test_unseen_labels_and_missing_numbers(sample, trained):
    odd = sample.limit(1).withColumn("Carrier", F.lit("??"))
    with pytest.raises(Exception):
        scoring.score(odd, trained.model).collect()
    assert scoring.score(odd, trained.model, "skip").count() == 0
    assert scoring.score(odd, trained.model, "keep").first().Prediction in (0.0, 1.0, 2.0, 3.0)
    blank = sample.limit(1).withColumn("DepDelay", F.lit(None).cast("double"))
    with pytest.raises(Exception):
        scoring.score(blank, trained.model).collect()
    assert scoring.score(blank, trained.model, "keep").count() == 1
    assert scoring.score(sample.limit(3), trained.model).count() == 3  # the model itself was not changed


def test_indices_from_the_message(sample, trained):
    asked = sample.where("FlightNum = '7'")
    blank = asked
    for name in schemas.INDEX_FIELDS:
        blank = blank.withColumn(name, F.lit(None).cast("double"))
    assert scoring.score(blank, trained.model, index_source="message").count() == asked.count()
    model = trained.model
    indexed = training.indexed(training.with_route(asked), model.labels, model.sizes, model.hashed, "error").drop("Route")
    pick = ["DepDelay", "ArrDelay", "Carrier", "Origin", "Dest", "Prediction"]
    assert rows(scoring.score(indexed, trained.model, index_source="message").select(*pick)) == rows(
        scoring.score(asked, trained.model).select(*pick))
    with pytest.raises(ValueError):
        scoring.score(asked, trained.model, index_source="other")


def test_forest_as_a_table(spark, sample, trained, tmp_path):
    """Joins with the table of nodes give the classes of the chain, also for unseen labels and missing numbers."""
    path = str(tmp_path / "forest")
    training.save(trained.model, path)
    table = forest_table.nodes(spark, path)
    assert table.select("tree").distinct().count() == 20 and table.where("leaf AND (threshold IS NOT NULL OR left_values IS NOT NULL)").count() == 0
    odd = sample.limit(60).withColumns({"Origin": F.lit("??"), "DepDelay": F.when(F.col("DepDelay") > 10, F.col("DepDelay"))})
    sample.unionByName(odd).withColumn("id", F.monotonically_increasing_id()).write.parquet(str(tmp_path / "asked"))
    asked = spark.read.parquet(str(tmp_path / "asked"))
    model = training.load(spark, path)
    depth = forest_table.levels(table)
    assert 1 <= depth <= 5
    got = forest_table.classified(forest_table.feature_rows(asked, model, "id"), table, "id", depth)
    want = scoring.score(asked, model, "keep").select("id", "Prediction")
    assert rows(got) == rows(want) and got.select("Prediction").distinct().count() > 1


def test_regression(sample):
    model = training.train_regression(sample)
    scored = training.score_regression(sample, model)
    assert set(scored.columns) == {*sample.columns, "Delay"} and scored.count() == sample.count()
    spread = scored.agg(F.avg(F.pow(F.col("Delay") - F.col("ArrDelay"), 2)), F.var_pop("ArrDelay")).first()
    assert spread[0] <= spread[1]
    line = training.fit_line(sample, "DepDelay", "ArrDelay").first()
    exact = sample.agg(F.regr_slope("ArrDelay", "DepDelay"), F.regr_intercept("ArrDelay", "DepDelay")).first()
    assert tuple(line) == pytest.approx(tuple(exact))
    unknown = sample.limit(1).withColumn("Origin", F.lit("??")).withColumn("Distance", F.lit(None).cast("double"))
    assert training.score_regression(unknown, model).first().Delay is not None


def test_regression_has_a_weight_per_label(spark, sample, tmp_path):
    """No hash width: as many weights as labels, and predictions follow from the exported table."""
    model = training.train_regression(sample, ["Origin"], [], max_iter=200, regularisation=0.0, tolerance=1e-12)
    weights = {(r["column_name"], r.label): r.weight for r in training.regression_weights(model).collect()}
    origins = {r.Origin for r in sample.select("Origin").distinct().collect()}
    assert set(weights) == {("Origin", o) for o in origins} | {("intercept", None)}
    mean = {r.Origin: r.m for r in sample.groupBy("Origin").agg(F.avg("ArrDelay").alias("m")).collect()}
    path = str(tmp_path / "line")
    training.save_regression(model, path)
    for row in training.score_regression(sample, training.load_regression(spark, path)).select("Origin", "Delay").distinct().collect():
        assert row.Delay == pytest.approx(weights["Origin", row.Origin] + weights["intercept", None], abs=1e-9)
        assert row.Delay == pytest.approx(mean[row.Origin], abs=1e-4)


def test_target_encoding_is_out_of_fold(spark):
    made = [(f"k{i % 7}" if i % 11 else None, float(i * 37 % 101), i % 3) for i in range(400)] + [("solo", 1000.0, 1)]
    df = spark.createDataFrame(made, "k string, t double, f int").withColumn("id", F.monotonically_increasing_id())
    got = {r.id: r.m for r in encoding.encoded_by_fold(df, ["k"], "t", F.col("f"), {"k": "m"}, weight=4.0).collect()}
    for r in df.collect():
        others = [x for x in made if x[2] != r.f]
        mine = [t for k, t, _ in others if k == r.k]
        prior = sum(x[1] for x in others) / len(others)
        assert got[r.id] == pytest.approx((sum(mine) + 4 * prior) / (len(mine) + 4))
    parts = encoding.sums(df, ["k"], "t", F.col("f"))
    prior = encoding.prior_of(parts)
    assert prior == pytest.approx(sum(x[1] for x in made) / len(made))
    table = {r.label: r["mean"] for r in encoding.means(parts, prior, 4.0).collect()}
    assert table["solo"] == pytest.approx((1000 + 4 * prior) / 5) and None in table
    assert encoding.prior_of(parts.where("n < 0")) == 0.0


def test_encoded_forest_needs_few_bins(spark, sample, tmp_path):
    """A column of very many labels: as a number it needs no bin for each, and held-out accuracy is no worse."""
    wide = sample.withColumn("Dest", F.concat("Dest", F.lit("-"), F.pmod(F.xxhash64("FlightNum", "DepDelay"), F.lit(300)).cast("string")))
    kept, held = ordering.split_by_key(wide, F.concat_ws("-", "FlightNum", "DepDelay", "ArrDelay"), 4)
    trained = training.train(kept, encoded=("Dest", "Route"), holdout=held)
    assert set(trained.model.sizes) == {"Carrier", "Origin"} and set(trained.model.encoded) == {"Dest", "Route"}
    assert trained.model.chain.stages[-1].getOrDefault("maxBins") == 32
    most = held.select(aggregates.bucket_delay(F.col("ArrDelay")).alias("b")).groupBy("b").count().agg(F.max("count")).first()[0]
    assert trained.accuracy() >= most / held.count() - 0.02
    path = str(tmp_path / "m")
    training.save(trained.model, path)
    unseen = held.withColumn("Dest", F.lit("nowhere"))
    again = training.load(spark, path)
    assert again.sizes == trained.model.sizes and again.encoded == trained.model.encoded
    assert scoring.score(unseen, again).where("Prediction IS NULL").count() == 0 and scoring.score(unseen, again).count() == held.count()


def test_daily_chain(spark, sample, trained, tmp_path):
    tasks_base, results_base, table = (str(tmp_path / name) for name in ("tasks", "results", "table"))
    tasks = sample.select(*[c for c in schemas.BATCH_REQUEST.fieldNames() if c != "Timestamp"],
                          F.expr("timestamp'2016-12-25 00:00:00' + make_dt_interval(0, int(FlightNum))").alias("Timestamp"))
    day = "2016-12-26"
    daily.fetch_requests(tasks, tasks_base, day)
    daily.score_day(spark, tasks_base, results_base, day, trained.model)
    for _ in range(2):
        daily.load_results(spark, results_base, table, day)
    expected = tasks.where("to_date(Timestamp) = '2016-12-26'")
    loaded = readers.collection(spark, "parquet", path=table)
    assert loaded.count() == expected.count() > 0
    page = daily.results_page(loaded, day)
    assert page.columns == ["Timestamp", "Carrier", "FlightDate", "Origin", "Dest", "Distance", "DepDelay", "Predicted"]
    assert page.count() == expected.count() and page.where("Predicted IS NULL").count() == 0
    assert daily.results_page(loaded, "2016-12-30").count() == 0
    three = daily.results_page(loaded, day, DELAY_CLASSES_3)
    assert {r.Predicted for r in three.collect()} <= {*DELAY_CLASSES_3.values(), None}


def test_a_day_that_became_empty_leaves_no_old_rows(spark, sample, trained, tmp_path):
    tasks_base, results, table = (str(tmp_path / name) for name in ("tasks", "results", "table"))
    tasks = sample.select(*[c for c in schemas.BATCH_REQUEST.fieldNames() if c != "Timestamp"]).withColumn("Timestamp", F.lit("2016-12-26 10:00").cast("timestamp"))
    for asked in (tasks, tasks.limit(0)):
        daily.fetch_requests(asked, tasks_base, "2016-12-26")
        daily.score_day(spark, tasks_base, results, "2016-12-26", trained.model)
        daily.load_results(spark, results, table, "2016-12-26")
        loaded = spark.read.schema(daily.result_schema()).parquet(table)
        assert loaded.count() == asked.count()


def test_forest_table_spreads_rows_of_one_partition(spark):
    """Rows read as one partition walk the trees in several tasks, with the same classes."""
    classes = len(aggregates.DELAY_SPLITS) - 1
    vote = lambda place: [1.0 if i == place else 0.0 for i in range(classes)]
    table = spark.createDataFrame(
        [(0, 0, False, 0, 1.0, None, None, 1, 2, vote(0)), (0, 1, True, None, None, None, None, -1, -1, vote(1)),
         (0, 2, True, None, None, None, None, -1, -1, vote(2))],
        "tree int, node int, leaf boolean, feature int, threshold double, left_values array<double>, unseen_left double, left int, "
        "right int, votes array<double>")
    asked = spark.createDataFrame([(i, [float(i % 3)]) for i in range(40)], "id long, features array<double>").coalesce(1)
    got = forest_table.classified(asked, table, "id", forest_table.levels(table))
    assert "RepartitionByExpression" in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(rows(got)) == [(i, 1.0 if i % 3 <= 1 else 2.0) for i in range(40)]


def test_indexed_sends_few_labels_to_the_rows(spark):
    """Rows of a frequent label are not dealt into one task by a join on the label; their indexes stay the same."""
    flights = spark.createDataFrame([(i, "AA" if i % 4 else "HA") for i in range(40)], "id long, Carrier string")
    labels = training.label_index(flights, ["Carrier"]).select("column_name", "label", "index")
    got = training.indexed(flights, labels, {"Carrier": 2}, {}, "error", ["Carrier"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan and "Join LeftOuter" in plan
    assert sorted(rows(got)) == [(i, "AA" if i % 4 else "HA", 0.0 if i % 4 else 1.0) for i in range(40)]


def test_forest_table_sends_nodes_to_the_rows_and_asks_nominal_values_by_bit(spark):
    """Rows meet the nodes where they are, also where the planner would not broadcast; every nominal value goes where its list says."""
    classes = len(aggregates.DELAY_SPLITS) - 1
    vote = lambda place: [1.0 if i == place else 0.0 for i in range(classes)]
    left = [0.0, 5.0, 63.0, 64.0, 127.0, 130.0]
    table = spark.createDataFrame(
        [(0, 0, False, 0, None, left, 140.0, 1, 2, vote(0)), (0, 1, True, None, None, None, None, -1, -1, vote(1)),
         (0, 2, True, None, None, None, None, -1, -1, vote(2)), (1, 0, False, 0, None, [], None, 1, 2, vote(0)),
         (1, 1, True, None, None, None, None, -1, -1, vote(0)), (1, 2, True, None, None, None, None, -1, -1, [0.1] * classes)],
        "tree int, node int, leaf boolean, feature int, threshold double, left_values array<double>, unseen_left double, left int, "
        "right int, votes array<double>")
    values = [*map(float, range(160)), 63.5, -1.0, 1e300]
    asked = spark.createDataFrame(list(enumerate([value] for value in values)), "id long, features array<double>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = forest_table.classified(asked, table, "id", forest_table.levels(table))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("strategy=broadcast") == 2 and "array_contains" not in plan
        assert dict(map(tuple, got.collect())) == {i: 1.0 if v in left or v >= 140.0 else 2.0 for i, v in enumerate(values)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_means_of_few_labels_are_sent_to_the_rows(spark, tmp_path):
    """Encoding moves no row: the written means are small, whatever the product of the sums they are joined from is estimated at."""
    made = spark.range(3000).selectExpr("id", "concat('L', id % 7) AS label", "CAST(id % 13 AS DOUBLE) AS delay")
    made.write.parquet(str(tmp_path / "rows"))
    known, fold = spark.read.parquet(str(tmp_path / "rows")), F.col("id") % 5
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        got = encoding.encoded_by_fold(known, ["label"], "delay", fold, {"label": "mean"})
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        found = {row.id: row["mean"] for row in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    delays = [(i, i % 7, i % 5, float(i % 13)) for i in range(3000)]
    for i, label, of, _ in delays[:40]:
        others = [d for _, _, f, d in delays if f != of]
        same = [d for _, n, f, d in delays if f != of and n == label]
        assert found[i] == pytest.approx((sum(same) + sum(others) / len(others) * encoding.WEIGHT) / (len(same) + encoding.WEIGHT))
