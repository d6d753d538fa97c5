"""Contracts, JSON messages, partitioned writes and streaming ingest."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.functions import parse_ts
from seriesloom.operators.windows import acceleration
from seriesloom.plans.furnace import CONTRACT
from seriesloom.sources.contract import Contract, check_contract, conform, spark_type
from seriesloom.sources.files import export_results, read_csv, read_table, with_date_parts, write_table
from seriesloom.sources.messages import decode_json, encode_json, read_stream
from seriesloom.streaming.ingest import Topic, ingest_available, progress, write_stream
from seriesloom.streaming.live import stream_refresh, stream_resample, window_start

T0 = datetime(2024, 1, 1)


def test_contract_schemas():
    sensors = CONTRACT.schema("sensors", with_tag=True)
    assert len(sensors) == 29 and sensors["dt"].dataType == T.StringType()
    assert CONTRACT.schema("sensors", with_tag=True) == sensors  # building a schema leaves no trace
    assert CONTRACT.schema("silver").fieldNames()[:2] == ["si_dt", "Si"] and len(CONTRACT.schema("silver")) == 29
    assert spark_type("decimal") == T.StringType()


def test_conform(spark):
    df = spark.createDataFrame([("1.5", 1), ("x", 2)], "a string, b int")
    want = T.StructType().add("a", "double").add("c", "string")
    assert check_contract(df, want) == ["a is string, not double", "missing column c"]
    fixed = conform(df, want)
    assert check_contract(fixed, want) == []
    assert [r["a"] for r in fixed.collect()] == [1.5, None]


def test_json_edges(spark):
    rows = [('{"dt": "2024-01-01 05:00:00", "x": 1.5}',), ("{broken",), ('{"dt": "nonsense", "x": NaN}',)]
    schema = T.StructType().add("dt", "string").add("x", "double")
    df = decode_json(spark.createDataFrame(rows, "value string"), schema)
    dated = with_date_parts(df, "dt").collect()
    assert (dated[0]["year"], dated[0]["month"], dated[0]["day"]) == (2024, 1, 1)
    assert dated[1]["dt"] is None and dated[1]["year"] >= 2024
    assert df.select(parse_ts("dt")).collect()[2][0] is None
    text = encode_json(df.limit(1), "first").first()["value"]
    assert text == '{"dt":"2024-01-01 05:00:00","x":1.5,"source_type":"first"}'


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    write_table(df, path, partition_by=["p"])
    write_table(df.where("p = 'a'").withColumn("x", F.lit(9)), path, partition_by=["p"], dynamic=True)
    assert sorted((r["x"], r["p"]) for r in read_table(spark, path).collect()) == [(2, "b"), (9, "a")]
    with pytest.raises(ValueError):
        write_table(df, path, dynamic=True)


def test_time_range_reaches_the_scan(spark, sf):
    df = read_table(spark, f"{sf}/events.parquet", "ts", ("2024-01-10", "2024-01-11"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_export_name(spark, tmp_path):
    df = spark.createDataFrame([(1, "ä")], "x int, s string")
    path = export_results(df, str(tmp_path), "run7", datetime(2024, 3, 5, 14, 7))
    assert path.endswith("results_run7_20240305_1407.csv")
    assert [tuple(r) for r in read_csv(spark, path).collect()] == [(1, "ä")]


def feed(spark, path, rows, schema):
    """One file per call, so that a rate limit of one file makes one micro-batch of it."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_ingest_continues_from_its_checkpoint(spark, tmp_path):
    schema = T.StructType().add("dt", "string").add("x", "double")
    src, base = str(tmp_path / "in"), str(tmp_path / "bronze")
    topics = {"s": Topic(schema, "sensors", {"kind": "text", "path": src, "rate_limit": 1})}
    for day in (1, 2):
        row = spark.createDataFrame([(f'{{"dt": "2024-01-0{day} 01:00:00", "x": {day}}}',)], "value string")
        row.coalesce(1).write.mode("append").text(src)
        report = ingest_available(spark, topics, base)["s"]
        assert report["total_rows"] == 1 and not report["active"]
    rows = read_table(spark, f"{base}/sensors").collect()
    assert sorted((r["x"], r["day"]) for r in rows) == [(1.0, 1), (2.0, 2)]


def test_rate_limit_makes_micro_batches(spark, tmp_path):
    src = str(tmp_path / "in")
    for i in range(3):
        feed(spark, src, [(i,)], "x int")
    sdf = read_stream(spark, "parquet", src, "x int", rate_limit=1)
    q = write_stream(sdf, str(tmp_path / "out"), str(tmp_path / "c"), "available")
    q.awaitTermination()
    assert progress(q)["batch_id"] == 2 and spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_streamed_resample_closes_windows_with_the_watermark(spark, tmp_path):
    src = str(tmp_path / "in")
    for hours in ([0.1, 0.5, 1.2], [1.7, 2.1], [9.0]):
        feed(spark, src, [(T0 + timedelta(hours=h), h) for h in hours], "ts timestamp, v double")
    sdf = read_stream(spark, "parquet", src, "ts timestamp, v double", rate_limit=1)
    out = window_start(stream_resample(sdf, "ts", "1 hour", {"v": "max"}, "1 hour"), "hour")
    write_stream(out, str(tmp_path / "out"), str(tmp_path / "c"), "available").awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("hour").collect()
    assert [(r["hour"].hour, r["v"]) for r in rows] == [(0, 0.5), (1, 1.7), (2, 2.1)]


def test_streamed_refresh_equals_batch(spark, tmp_path):
    schema = "k int, ts timestamp, v double"
    src = str(tmp_path / "in")
    batches = [
        [(0, 0.0, 1.0), (0, 1.0, 2.0), (1, 0.5, 5.0)],
        [(0, 2.5, 4.0), (0, 2.0, 3.0), (1, 1.5, 6.0)],  # out of order, within the watermark
        [(0, 4.0, 9.0), (1, 4.0, 1.0)],
        [(0, 90.0, 0.0), (1, 90.0, 0.0)],
    ]
    rows = [(k, T0 + timedelta(hours=h), v) for b in batches for k, h, v in b]
    for b in batches:
        feed(spark, src, [(k, T0 + timedelta(hours=h), v) for k, h, v in b], schema)
    sdf = read_stream(spark, "parquet", src, schema, rate_limit=1)
    fresh = stream_refresh(sdf, "ts", ["v"], ["k"], "2 hours")
    write_stream(fresh, str(tmp_path / "out"), str(tmp_path / "c"), "available").awaitTermination()
    cols = ["k", "ts", "v", "v_velocity", "v_acceleration"]
    got = spark.read.parquet(str(tmp_path / "out")).select(cols).orderBy("k", "ts").collect()
    want = acceleration(spark.createDataFrame(rows, schema), "ts", {"v": "v"}, ["k"]).select(cols)
    want = want.where(F.col("ts") < F.lit(T0 + timedelta(hours=80))).orderBy("k", "ts").collect()
    assert len(got) == len(want) == 8
    for a, b in zip(got, want):
        assert tuple(a)[:3] == tuple(b)[:3]
        assert tuple(a)[3:] == pytest.approx(tuple(b)[3:])


def test_contract_from_a_mapping():
    spec = {"feed": {"type": "double", "columns": ["a", "b"]}, "notes": {"type": "string", "columns": ["c"]}, "gas": {"columns": ["d"]}}
    contract = Contract.from_mapping(spec, {"y": "double"}, time="t")
    assert contract.sensors == ["a", "b", "c", "d"]
    kinds = [f.dataType.simpleString() for f in contract.schema("sensors").fields]
    assert contract.schema("sensors").fieldNames()[0] == "t" and kinds == ["string", "double", "double", "string", "double"]
    with pytest.raises(ValueError):
        Contract.from_mapping({"a": {"columns": ["x"]}, "b": {"columns": ["x"]}}, {})


def test_time_range_skips_partitions(spark, tmp_path):
    path = str(tmp_path / "dated")
    rows = [(i, str(T0 + timedelta(hours=7 * i))) for i in range(60)]
    write_table(with_date_parts(spark.createDataFrame(rows, "i int, dt string"), "dt"), path, partition_by=["year", "month", "day"])
    span = ("2024-01-03 05:00:00", "2024-01-05 00:00:00")
    df = read_table(spark, path, "dt", span, dated=True)
    assert [r["i"] for r in df.orderBy("i").collect()] == [i for i, t in rows if span[0] <= t < span[1]]
    assert len(df.select("_metadata.file_path").distinct().collect()) == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "make_date(year" in plan[plan.index("PartitionFilters") :]


def test_routed_publishing(spark, tmp_path):
    from seriesloom.sources.messages import publish_stream, route, to_folders, unrouted

    df = spark.createDataFrame([(i, f"2024-01-0{i % 5 + 1}", t) for i, t in enumerate(["a", "b", "c", None, "d", "a"])], "x int, dt string, source_type string")
    topics = {"a": "sensors", "b": "sensors", "c": "targets"}
    assert sorted((r.topic, r.value.count("source_type")) for r in route(df, topics).collect()) == [("sensors", 1)] * 3 + [("targets", 1)]
    assert sorted(r.x for r in unrouted(df, topics).collect()) == [3, 4]
    for part in (0, 1):
        df.where(f"x % 2 = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = read_stream(spark, "parquet", str(tmp_path / "in"), df.schema, rate_limit=1)
    send, calls = to_folders(str(tmp_path / "out")), []

    def twice(messages, batch_id):  # as after a failure between the write and the commit
        calls.append(batch_id)
        send(messages, batch_id)
        send(messages, batch_id)

    publish_stream(stream, topics, twice, str(tmp_path / "c")).awaitTermination()
    found = spark.read.text(str(tmp_path / "out"))
    assert len(calls) >= 2 and found.groupBy("topic").count().collect() and found.count() == 4
    assert {r.topic: r.n for r in found.groupBy("topic").agg(F.count("*").alias("n")).collect()} == {"sensors": 3, "targets": 1}


def test_progress_counts_all_batches(spark, tmp_path):
    from seriesloom.streaming.ingest import Progress, await_any

    spark.range(60).repartition(12).write.parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    seen = Progress()
    spark.streams.addListener(seen)
    try:
        stream = read_stream(spark, "parquet", str(tmp_path / "in"), "id long", rate_limit=1)
        q = write_stream(stream, str(tmp_path / "out"), str(tmp_path / "c"), "available")
        assert await_any(spark, 60)
        total = seen.wait(q)
        assert total["total_rows"] == 60 > progress(q)["total_rows"]
        assert total["batches"] >= 12 and not total["active"] and total["error"] is None
        spark.streams.resetTerminated()
        failing = write_stream(stream.selectExpr("raise_error('no') as x"), str(tmp_path / "o2"), str(tmp_path / "c2"), "available")
        with pytest.raises(Exception, match="no"):
            failing.awaitTermination()
        with pytest.raises(Exception, match="no"):
            await_any(spark, 60)
    finally:
        spark.streams.resetTerminated()
        spark.streams.removeListener(seen)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
