"""The command-line jobs, one after another, as an operator would run them."""

import datetime as dt
import random

import pytest

from skyledger.__main__ import main
from skyledger.sources import keyed
from tests.conftest import rows


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("jobs"))
    pick = random.Random(9)
    made = []
    for i in range(400):
        delay = float(pick.randrange(-40, 90))
        made.append((pick.choice(["AA", "DL"]), pick.choice(["ATL", "SFO"]), pick.choice(["ORD", "JFK"]), f"N{i % 9}", str(i),
                     "2015-12-31", 2015, 12, 31, 4, 606.5, delay, delay, "0905", "1010"))
    spark.createDataFrame(made, "Carrier string, Origin string, Dest string, TailNum string, FlightNum string, FlightDate string, "
                                "Year int, Month int, DayofMonth int, DayOfWeek int, Distance double, DepDelay double, "
                                "ArrDelay double, CRSDepTime string, CRSArrTime string").write.parquet(f"{base}/flights")
    spark.createDataFrame([("N1", "Boeing"), ("N2", "Airbus"), ("N3", "Boeing")], "TailNum string, Manufacturer string").write.parquet(
        f"{base}/airplanes")
    asked = [("AA", 31, 4, 365, float(i), "ORD", 606.0, dt.date(2015, 12, 31), str(i), "ATL",
              dt.datetime(2016, 12, 25) + dt.timedelta(hours=i)) for i in range(30)]
    spark.createDataFrame(asked, "Carrier string, DayOfMonth int, DayOfWeek int, DayOfYear int, DepDelay double, Dest string, "
                                 "Distance double, FlightDate date, FlightNum string, Origin string, Timestamp timestamp"
                          ).write.parquet(f"{base}/tasks")
    return base


def test_jobs_in_sequence(spark, base, capsys):
    main(["extract-features", "--flights", f"{base}/flights", "--out", f"{base}/features"], spark)
    main(["extract-features", "--flights", f"{base}/flights", "--out", f"{base}/sample", "--one-in", "4"], spark)
    assert spark.read.json(f"{base}/features").count() == 400
    assert 40 < spark.read.json(f"{base}/sample").count() < 180

    main(["distances", "--flights", f"{base}/flights", "--out", f"{base}/distances", "--table", f"{base}/distance_table"], spark)
    assert spark.read.parquet(f"{base}/distance_table").count() == 4
    main(["distances", "--flights", f"{base}/flights", "--out", f"{base}/distances", "--table", f"{base}/distance_table2",
          "--old-table", f"{base}/distance_table"], spark)
    assert spark.read.parquet(f"{base}/distance_table2").count() == 4

    main(["build-pages", "--flights", f"{base}/flights", "--airplanes", f"{base}/airplanes", "--out", f"{base}/pages"], spark)
    assert rows(spark.read.parquet(f"{base}/pages/flights_by_month")) == [(2015, 12, 400)]
    assert spark.read.parquet(f"{base}/pages/flights_per_airplane").count() == 400
    assert spark.read.parquet(f"{base}/pages/airplanes_per_carrier").select("Carrier").distinct().count() == 2
    assert [tuple(r) for r in spark.read.parquet(f"{base}/pages/airplane_manufacturer_totals").collect()] == [("Boeing", 2), ("Airbus", 1)]

    main(["train", "--features", f"{base}/features", "--model", f"{base}/model", "--max-bins", "64"], spark)
    assert "accuracy" in capsys.readouterr().out

    main(["fetch-requests", "--tasks", f"{base}/tasks", "--base", f"{base}/daily", "--date", "2016-12-25"], spark)
    for _ in range(2):
        main(["score-day", "--base", f"{base}/daily", "--date", "2016-12-25", "--model", f"{base}/model"], spark)
        main(["load-results", "--base", f"{base}/daily", "--date", "2016-12-25", "--table", f"{base}/results"], spark)
    assert spark.read.parquet(f"{base}/results").count() == 24

    asked = spark.read.parquet(f"{base}/tasks").selectExpr("to_json(struct(FlightNum AS UUID, *)) AS value")
    asked.write.parquet(f"{base}/inbox")
    main(["score-stream", "--format", "parquet", "--input", f"{base}/inbox", "--model", f"{base}/model",
          "--table", f"{base}/responses", "--checkpoint", f"{base}/checkpoint"], spark)
    assert keyed.responses(spark, f"{base}/responses").count() == 30
    assert spark.read.parquet(f"{base}/responses-messages").count() == 30

    main(["listen-responses", "--format", "parquet", "--input", f"{base}/responses-messages/batch_id=0",
          "--table", f"{base}/listened", "--checkpoint", f"{base}/listen-checkpoint"], spark)
    assert keyed.responses(spark, f"{base}/listened").count() == 30

    forms = [("5", "AA", "2016-12-25", "ORD", "1", "ATL"), ("x", "AA", "bad", "XXX", "2", "ATL")]
    spark.createDataFrame(forms, "DepDelay string, Carrier string, FlightDate string, Dest string, FlightNum string, Origin string"
                          ).write.json(f"{base}/forms")
    spark.read.json(f"{base}/forms").selectExpr("to_json(struct(*)) AS value").write.parquet(f"{base}/form_messages")
    common = ["--forms", f"{base}/forms", "--distances", f"{base}/distances"]
    for _ in range(2):
        main(["build-requests", *common, "--out", f"{base}/tasks"], spark)
    added = spark.read.parquet(f"{base}/tasks").where("Timestamp > '2017-01-01'")
    assert rows(added.select("FlightNum", "DepDelay", "Distance", "DayOfWeek").distinct()) == [
        ("1", 5.0, 606.5, 7), ("2", None, 0.0, None)] and added.count() == 4
    main(["build-requests", *common, "--topic", "requests", "--format", "noop"], spark)
    main(["train-regression", "--features", f"{base}/features", "--model", f"{base}/regression"], spark)
    main(["regress-requests", *common, "--model", f"{base}/regression", "--out", f"{base}/delays"], spark)
    assert spark.read.json(f"{base}/delays").where("Delay IS NOT NULL").count() == 2

    main(["enrich-stream", "--input", f"{base}/form_messages", "--distances", f"{base}/distances", "--out", f"{base}/enriched",
          "--checkpoint", f"{base}/enrich-checkpoint"], spark)
    assert spark.read.parquet(f"{base}/enriched").count() == 2
    spark.sql("SELECT '{\"UUID\":\"a\",\"Timestamp\":\"2020-01-01T00:00:00\",\"Prediction\":1}' AS value").write.parquet(f"{base}/answers")
    main(["status-stream", "--requests", f"{base}/answers", "--responses", f"{base}/answers", "--out", f"{base}/status",
          "--checkpoint", f"{base}/status-checkpoint"], spark)
    assert rows(spark.read.parquet(f"{base}/status").selectExpr("UUID", "status", "Prediction", "date_format(AnsweredAt, 'yyyy-MM-dd HH:mm')")) == [
        ("a", "OK", 1.0, "2020-01-01 00:00")]


def test_unknown_job():
    with pytest.raises(SystemExit):
        main(["no-such-job"])
