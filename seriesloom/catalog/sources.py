"""Sources, sinks and contracts: tables written with one operator and read back with another."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse_ts
from ..operators.quality import require_rows
from ..plans.furnace import CONTRACT
from ..sources.staging import stage_folder
from ..sources.contract import check_contract, conform
from ..sources.files import (
    export_results,
    read_contract,
    read_csv,
    read_table,
    with_date_parts,
    write_csv,
    write_table,
)
from ..sources.messages import decode_json, encode_json
from .base import SENSOR_SQL, plant_sensors, query, round_all, rounded_sql, table


def _path(spark, name: str) -> str:
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_round_trip", "select o_orderkey, o_totalprice, o_orderstatus, o_orderdate from orders")
def csv_round_trip(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    return read_csv(spark, write_csv(df, _path(spark, "orders-csv")), df.schema)


@query("csv_inferred_types", "select p_partkey, p_size, p_retailprice, p_brand from part")
def csv_inferred(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_brand")
    back = read_csv(spark, write_csv(df, _path(spark, "part-csv")))
    return back.select(*[F.col(f.name).cast(f.dataType) for f in df.schema.fields])


@query("export_results", f"select event_type, count(*) as n, {rounded_sql('avg(value)')} as mean_value from events group by 1")
def export(spark, sf):
    df = table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")
    )
    df = round_all(df, ["mean_value"])
    path = export_results(df, _path(spark, "exports"), "events", datetime(2024, 1, 31, 6, 0))
    return read_csv(spark, path, df.schema)


@query(
    "contract_read_with_time_range",
    "select event_id, ts, value from events where ts >= '2024-01-10' and ts < '2024-01-12'",
)
def contract_read(spark, sf):
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    return read_contract(spark, f"{sf}/events.parquet", schema, "ts", ("2024-01-10", "2024-01-12"))


@query("table_read", "select n_nationkey, n_name, n_regionkey from nation")
def table_read(spark, sf):
    return read_table(spark, f"{sf}/nation.parquet").select("n_nationkey", "n_name", "n_regionkey")


@query("table_overwrite", "select c_custkey, c_acctbal from customer where c_acctbal > 0")
def table_overwrite(spark, sf):
    path = _path(spark, "customer")
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    write_table(df, path)
    write_table(df.where("c_acctbal > 0"), path)
    return read_table(spark, path)


@query(
    "dynamic_partition_overwrite",
    """select o_orderkey, o_orderstatus, case when o_orderstatus = 'P' then 0e0 else o_totalprice end as o_totalprice
from orders""",
)
def dynamic_overwrite(spark, sf):
    path = _path(spark, "orders")
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_table(df, path, partition_by=["o_orderstatus"])
    changed = df.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(0.0))
    write_table(changed, path, partition_by=["o_orderstatus"], dynamic=True)
    return read_table(spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("json_decode", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_decode(spark, sf):
    df = table(spark, sf, "events").select(
        F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(", "), F.expr("substr(props, 2)"))
        .cast("binary")
        .alias("value")
    )
    return decode_json(df, T.StructType().add("event_id", T.LongType()).add("k", T.LongType()))


@query("json_round_trip", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as dt, value, 'first' as source_type from events")
def json_round_trip(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("dt"), "value"
    )
    schema = (
        T.StructType()
        .add("event_id", T.LongType())
        .add("dt", T.StringType())
        .add("value", T.DoubleType())
        .add("source_type", T.StringType())
    )
    return decode_json(encode_json(df, "first"), schema)


@query(
    "lenient_timestamps",
    """select event_id, case when event_id % 3 <> 0 then cast(date_trunc('second', ts) as timestamp) end as t from events""",
)
def lenient_timestamps(spark, sf):
    text = F.when(F.expr("event_id % 3 <> 0"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("not a time")
    return table(spark, sf, "events").select("event_id", parse_ts(text).alias("t"))


@query(
    "date_parts",
    """select event_id, cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
  cast(day(ts) as integer) as day from events""",
)
def date_parts(spark, sf):
    return with_date_parts(table(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


@query(
    "contract_conform",
    f"select dt, {', '.join(CONTRACT.sensors)}, cast(null as varchar) as note from ({SENSOR_SQL})",
)
def contract_conform(spark, sf):
    wanted = CONTRACT.schema("sensors").add("note", T.StringType())
    df = conform(plant_sensors(spark, sf), wanted)
    if problems := check_contract(df, wanted):
        raise ValueError("; ".join(problems))
    return df


@query("non_empty_guard", "select count(*) as n from events")
def non_empty_guard(spark, sf):
    df = require_rows(table(spark, sf, "events"), "events")
    return df.agg(F.count(F.lit(1)).alias("n"))
