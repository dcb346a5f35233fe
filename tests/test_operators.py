"""Resources, sources, quality checks, streaming and models on small frames."""

import pytest
from pyspark.sql import functions as F

from gatecount.operators import modeling, quality, simulate
from gatecount.operators.resource import resource
from gatecount.sources import csv, synthetic
from gatecount.streaming.arrivals import windowed_arrivals


def test_resource_rules(spark):
    r = resource("sales", "sales")
    df = spark.createDataFrame([(i, i % 3, "WEB") for i in range(1500)], "sale_id long, event_id long, channel string")
    assert r.query(df, limit=5000, offset=-3).count() == 1000
    assert r.query(df, limit=0).count() == 100
    assert [x.sale_id for x in r.query(df, order="sale_id.desc", limit=2, offset=1).collect()] == [1498, 1497]
    assert r.count(df, channel="", event_id=1).first()["total"] == 500
    for bad in (lambda: r.where(df, colour="red"), lambda: r.select(df, "a;b"), lambda: r.page(df, "x y"), lambda: resource("members", "sales")):
        with pytest.raises(ValueError):
            bad()


def test_csv_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,name\n1,"a, b"\n2,\n3\n,\n', encoding="utf-8")
    loose = csv.read_strings(spark, str(tmp_path / "a.csv"), ["id", "name"])
    assert loose.columns == ["id", "name"] and loose.first()["name"] == "a, b"
    strict = csv.read_strings(spark, str(tmp_path / "a.csv"), ["id", "name"], strict=True)
    assert sorted(r.id for r in strict.collect()) == ["1", "2"]
    csv.write(strict, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2


def test_rejected_lines_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"a, b"\n2,\n3\n,\n4,x,y\n', encoding="utf-8")
    rows, rejects = csv.read_with_rejects(spark, str(tmp_path / "a.csv"), ["id", "name"])
    assert sorted((r.id, r.name) for r in rows.collect()) == [("1", "a, b"), ("2", None)]
    assert sorted((r.quality_issue, r.raw_line) for r in rejects.collect()) == [("BLANK_LINE", None), ("BROKEN_LINE", "3"), ("BROKEN_LINE", "4,x,y")]
    assert all(r.source_file.endswith("a.csv") for r in rejects.collect())


def test_typed_rows_say_their_file(spark, tmp_path):
    from gatecount.schema import TABLES

    (tmp_path / "s.csv").write_text("member_id,friends_count\n1,4\n2,many\n", encoding="utf-8")
    out = csv.read_typed(spark, str(tmp_path), TABLES["social"]).collect()
    assert sorted((r.member_id, r.friends_count) for r in out) == [("1", 4), ("2", None)] and all(r.source_file.endswith("s.csv") for r in out)


def test_words_in_their_own_order(spark):
    from gatecount.operators import analytics

    df = spark.createDataFrame([("c",), ("x",), ("a",), ("b",)], "w string")
    assert [(r.w, r.place) for r in analytics.in_word_order(df, "w", ("b", "a", "c")).collect()] == [("b", 1), ("a", 2), ("c", 3), ("x", 4)]


def test_quarantine_sink(spark, tmp_path):
    df = quality.key_quarantine(spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id long, v string"), ["id"], [F.col("v")])
    csv.append_quarantine(df, "t", str(tmp_path / "q"))
    assert sorted(r.quality_issue for r in spark.read.parquet(str(tmp_path / "q")).collect()) == ["DUPLICATE_KEY", "MISSING_KEY"]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "sale_id long, event_id long, price long, checked_in boolean, ticket_type string")
    train, score = quality.train_score_split(empty)
    assert train.count() == score.count() == 0
    assert quality.checks(none=(empty, F.col("price") >= 0)).first()["passed"]


def test_synthetic_members_repeat(spark):
    a, b = synthetic.members(spark, 50, 1), synthetic.members(spark, 50, 1).repartition(7)
    assert sorted(a.collect()) == sorted(b.collect())
    assert sorted(a.collect()) != sorted(synthetic.members(spark, 50, 2).collect())


def test_folds_keep_groups_whole(spark):
    df = spark.range(64).select((F.col("id") % 32).alias("g"))
    folds = modeling.group_folds(df, "g").collect()
    sizes = sorted(sum(r.fold == k for r in folds) for k in range(5))
    assert len(folds) == 32 and sizes == [6, 6, 6, 7, 7]


def test_auc_by_hand(spark):
    df = spark.createDataFrame([("m", 0.1, 0), ("m", 0.4, 0), ("m", 0.4, 1), ("m", 0.8, 1)], "model string, p double, label int")
    assert modeling.auc(df).first()["auc"] == 0.875


def test_model_artefact_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(str(i % 3), float(i % 7), float(i % 2)) for i in range(60)], "c string, x double, label double")
    fitted = modeling.pipeline("logistic", ["c"], ["x"], 60).fit(df)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    from pyspark.ml import PipelineModel

    again = PipelineModel.load(str(tmp_path / "m"))
    assert [r.prediction for r in fitted.transform(df).collect()] == [r.prediction for r in again.transform(df).collect()]
    unseen = spark.createDataFrame([("new", 1.0, 0.0)], df.schema)
    assert again.transform(unseen).count() == 1


def test_risk_and_overflow(spark):
    row = {"event_id": 1, "capacity": 10, "issued": 20, "n_0": 20, "n_1": 0, "n_2": 0, "n_3": 0, "rate_0": 0.9, "rate_1": 0.9, "rate_2": 0.9, "rate_3": 0.4, "rate_membership": 0.5, "rate_consumption": 0.7, "lift": 1.0, "phi": 1.0, "courtesy": 0, "membership": 0, "consumption": 0, "converted": 0}
    df = spark.createDataFrame([row]).withColumns({"baseline": F.lit(None).cast("double"), "baseline_sd": F.lit(None).cast("double")})
    out = simulate.project(df).first()
    assert (out.expected, out.demand, out.turned_away, out.risk_class) == (10, 18, 8, "critical")
    assert simulate.recommend(df).first()["suggested_free"] == 0
    assert simulate.sweep_split(df).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    rows = [(f"2024-01-01 10:{m:02d}:00", "view", float(m)) for m in range(0, 60, 5)]
    df = spark.createDataFrame(rows, "ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = windowed_arrivals(stream).writeStream.outputMode("complete").format("memory").queryName("arrivals").start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r.window_start, r.n, r.total) for r in spark.sql("select * from arrivals").collect())
    want = sorted((r.window_start, r.n, r.total) for r in windowed_arrivals(df).collect())
    assert got == want and len(got) == 4
