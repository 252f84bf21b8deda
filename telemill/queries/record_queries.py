"""Sources, sinks and manifest bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import status as ST
from ..session import new_path
from ..sources import records as R
from ..sources import scenarios as SC
from ..sources import series as SE
from .base import TELE, Registry, r6, table, tele, with_ctes

register = Registry()

ROWS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("device_id", T.LongType()),
        T.StructField("x", T.DoubleType()),
    ]
)
EVENTS = "select event_id, user_id as device_id, value as x"


def _rows(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("device_id"), F.col("value").alias("x"), "event_type"
    )


def _lookup(spark, sf):
    """Event types as scenarios, and one scenario that has no data."""
    names = table(spark, sf, "events").select("event_type").distinct()
    extra = table(spark, sf, "region").where("r_regionkey = 0").select(
        F.concat(F.lit("missing_"), F.lower("r_name")).alias("event_type")
    )
    kind = F.when(F.col("event_type") == "error", "failure").otherwise("normal")
    return SC.scenario_dim(
        names.unionByName(extra),
        F.length("event_type"),
        F.col("event_type"),
        F.substring("event_type", 1, 1),
        kind,
        F.concat(F.lit("All rows of type "), F.col("event_type")),
    )


@register(
    "scenario_dim",
    """select cast(length(n) as integer) as scenario_id, n as scenario, substr(n, 1, 1) as "group",
      case when n = 'error' then 'failure' else 'normal' end as kind, n = 'error' as faulty,
      'All rows of type ' || n as description
      from (select distinct event_type as n from events union all
        select 'missing_' || lower(r_name) from region where r_regionkey = 0)""",
)
def scenario_dim(spark, sf):
    path = new_path(spark, "scenarios")
    SC.write_scenario_dim(_lookup(spark, sf), path)
    return SC.read_scenario_dim(spark, path)


@register(
    "scenario_csv_read",
    f"{EVENTS}, event_type as scenario, cast(length(event_type) as integer) as scenario_id from events",
)
def scenario_csv_read(spark, sf):
    lookup, data = new_path(spark, "scenarios"), new_path(spark, "scenario-data")
    SC.write_scenario_dim(_lookup(spark, sf), lookup)
    SE.write_by_key(_rows(spark, sf).withColumnRenamed("event_type", "scenario"), data, "scenario")
    return SC.read_scenarios(spark, lookup, data, ROWS, by_folder="scenario")


@register("scenario_csv_write", f"{EVENTS}, event_type from events")
def scenario_csv_write(spark, sf):
    path = new_path(spark, "by-key")
    SE.write_by_key(_rows(spark, sf), path, "event_type")
    schema = T.StructType([*ROWS.fields, T.StructField("event_type", T.StringType())])
    return R.read_csv(spark, path, schema)


@register("series_parquet_read", "select user_id, value from events")
def series_parquet_read(spark, sf):
    return SE.read_series(spark, f"{sf}/events.parquet", ["user_id", "value"])


@register("series_parquet_write", f"{EVENTS}, event_type from events")
def series_parquet_write(spark, sf):
    path = new_path(spark, "series")
    SE.write_series(_rows(spark, sf), path, "event_type")
    return SE.read_series(spark, path)


@register(
    "series_dim",
    """select cast(s_suppkey as integer) as scenario_id, s_name as scenario,
      coalesce(f, 'all') as "group", case when f is null then 'normal' else 'failure' end as kind,
      f is not null as faulty, d as duration_days, q as decoy_freq_per_day,
      case when f is null then 'Healthy' else upper(f[1]) || f[2:] || ' failure' end || ' — '
        || printf('%.0f', d) || ' days, ~' || printf('%.1f', q) || ' decoys/day' as description
      from (select *, case s_nationkey % 3 when 1 then 'bearing' when 2 then 'radial' end as f,
        300.0::double + s_nationkey as d, s_nationkey * 0.5::double as q from supplier)""",
)
def series_dim(spark, sf):
    nat = F.col("s_nationkey")
    failure = F.when(nat % 3 == 1, "bearing").when(nat % 3 == 2, "radial")
    return SC.series_dim(
        table(spark, sf, "supplier"),
        F.col("s_suppkey"),
        F.col("s_name"),
        failure,
        F.lit(300.0) + nat,
        nat * 0.5,
    )


@register("fleet_layout", with_ctes(TELE, "select device_id, row_i, x, label from tele"))
def fleet_layout(spark, sf):
    path = new_path(spark, "fleet")
    SE.write_fleet(tele(spark, sf).select("device_id", "row_i", "x", "label"), path)
    return SE.read_fleet(spark, path)


@register(
    "file_stats",
    "select user_id as device_id, count(*) as num_rows, true as on_disk from events group by 1",
)
def file_stats(spark, sf):
    path = new_path(spark, "fleet")
    SE.write_fleet(_rows(spark, sf), path, row="event_id")
    return SE.file_stats(spark, path, "device_id").select(
        "device_id", "num_rows", (F.col("file_size_bytes") > 0).alias("on_disk")
    )


OVERRIDES = T.StructType(
    [
        T.StructField("s_suppkey", T.LongType()),
        T.StructField("duration_days", T.DoubleType()),
        T.StructField("save_freq_s", T.LongType()),
    ]
)


@register(
    "config_overrides",
    """select s_suppkey, case when s_nationkey % 2 = 0 then s_nationkey * 1.5::double
        else 365.0::double end as duration_days,
      case when s_nationkey % 3 = 0 then cast(s_nationkey as bigint) else 60::bigint end as save_freq_s,
      12345::bigint as base_seed from supplier""",
)
def config_overrides(spark, sf):
    nat = F.col("s_nationkey")
    sup = table(spark, sf, "supplier")
    given = sup.select(
        "s_suppkey",
        F.when(nat % 2 == 0, nat * 1.5).alias("duration_days"),
        F.when(nat % 3 == 0, nat).alias("save_freq_s"),
        F.lit("ignored").alias("unknown_field"),
    )
    path = new_path(spark, "config")
    R.write_config(given, path)
    defaults = sup.select(
        "s_suppkey",
        F.lit(365.0).alias("duration_days"),
        F.lit(60).cast("bigint").alias("save_freq_s"),
        F.lit(12345).cast("bigint").alias("base_seed"),
    )
    read = spark.read.schema(OVERRIDES).json(path)
    return R.apply_overrides(defaults, read, ["s_suppkey"])


FLAT = """select p_partkey, p_brand || '|' || p_type as decoy_types, 'pending' as status,
  0::bigint as num_rows, 0::bigint as file_size_bytes, 0.0::double as generation_time_s from part"""


def _configs(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.array("p_brand", "p_type").alias("decoy_types")
    )


@register("manifest_flatten", FLAT)
def manifest_flatten(spark, sf):
    return R.manifest_rows(_configs(spark, sf))


@register(
    "manifest_unflatten",
    "select p_partkey, p_brand as first_type, p_type as second_type, 2 as n from part",
)
def manifest_unflatten(spark, sf):
    path = new_path(spark, "manifest")
    R.write_csv(R.manifest_rows(_configs(spark, sf)), path)
    schema = T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("decoy_types", T.StringType()),
            *schemas.RESULTS.fields[-1:],
            *schemas.RESULTS.fields[1:-1],
        ]
    )
    types = F.col("decoy_types")
    return R.manifest_configs(R.read_csv(spark, path, schema)).select(
        "p_partkey",
        types[0].alias("first_type"),
        types[1].alias("second_type"),
        F.size(types).alias("n"),
    )


RESULTS = """results as (select printf('order_%08d', o_orderkey) as device_id,
    o_custkey as num_rows, cast(floor(o_totalprice) as bigint) as file_size_bytes,
    o_totalprice / 1000 as generation_time_s,
    case o_orderstatus when 'F' then 'completed' when 'O' then 'error: open' else 'pending' end
      as status from orders)"""


def results(spark, sf):
    state = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.format_string("order_%08d", "o_orderkey").alias("device_id"),
        F.col("o_custkey").alias("num_rows"),
        F.floor("o_totalprice").alias("file_size_bytes"),
        (F.col("o_totalprice") / 1000).alias("generation_time_s"),
        F.when(state == "F", "completed").when(state == "O", "error: open").otherwise("pending").alias(
            "status"
        ),
    )


@register("results_csv", with_ctes(RESULTS, "select * from results"))
def results_csv(spark, sf):
    path = new_path(spark, "results")
    R.write_results(results(spark, sf), path)
    return R.read_csv(spark, path, schemas.RESULTS)


@register(
    "params_current",
    """select c_custkey, c_acctbal >= 0 and c_mktsegment <> 'MACHINERY' as is_current
      from customer""",
)
def params_current(spark, sf):
    now = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    saved = now.where("c_acctbal >= 0").withColumn(
        "c_nationkey", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_nationkey"))
    )
    return R.same_params(saved, now, "c_custkey")


# -- manifest against results ------------------------------------------------

CUSTOMERS = """manifest as (select c_custkey as device_id, 'pending' as status, 0::bigint as num_rows,
    0::bigint as file_size_bytes, 0.0::double as generation_time_s from customer)"""
BY_CUSTOMER = """results as (select o_custkey as device_id,
    case when max(o_totalprice) > 400000 then 'completed' else 'error: small' end as status,
    count(*) as num_rows, cast(floor(max(o_totalprice)) as bigint) as file_size_bytes,
    max(o_totalprice) as generation_time_s from orders where o_orderstatus <> 'P' group by 1)"""


def _manifest(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("device_id"),
        F.lit("pending").alias("status"),
        F.lit(0).cast("bigint").alias("num_rows"),
        F.lit(0).cast("bigint").alias("file_size_bytes"),
        F.lit(0.0).alias("generation_time_s"),
    )


def _by_customer(spark, sf):
    top = F.max("o_totalprice")
    return (
        table(spark, sf, "orders")
        .where("o_orderstatus <> 'P'")
        .groupBy(F.col("o_custkey").alias("device_id"))
        .agg(
            F.when(top > 400000, "completed").otherwise("error: small").alias("status"),
            F.count(F.lit(1)).alias("num_rows"),
            F.floor(top).alias("file_size_bytes"),
            top.alias("generation_time_s"),
        )
    )


@register(
    "merge_results",
    with_ctes(
        CUSTOMERS,
        BY_CUSTOMER,
        """select m.device_id, coalesce(r.status, m.status) as status,
      coalesce(r.num_rows, m.num_rows) as num_rows,
      coalesce(r.file_size_bytes, m.file_size_bytes) as file_size_bytes,
      coalesce(r.generation_time_s, m.generation_time_s) as generation_time_s
      from manifest m left join results r using (device_id)""",
    ),
)
def merge_results(spark, sf):
    return ST.merge_results(_manifest(spark, sf), _by_customer(spark, sf))


@register(
    "pending_devices",
    with_ctes(
        CUSTOMERS,
        BY_CUSTOMER,
        """select * from manifest where device_id not in
      (select device_id from results where status = 'completed')""",
    ),
)
def pending_devices(spark, sf):
    return ST.pending(_manifest(spark, sf), _by_customer(spark, sf))


@register(
    "completeness",
    with_ctes(
        CUSTOMERS,
        BY_CUSTOMER,
        """select count(*) as expected, count(*) filter (r.file_size_bytes > 0) as valid,
      count(*) - count(*) filter (r.file_size_bytes > 0) as missing
      from manifest m left join results r using (device_id)""",
    ),
)
def completeness(spark, sf):
    return ST.validate(_manifest(spark, sf), _by_customer(spark, sf))


@register(
    "run_summary",
    with_ctes(
        RESULTS,
        """select count(*) filter (status = 'completed') as completed,
      count(*) filter (status <> 'completed') as failed,
      cast(coalesce(sum(num_rows) filter (status = 'completed'), 0) as bigint) as total_rows,
      cast(coalesce(sum(file_size_bytes) filter (status = 'completed'), 0) as bigint) as total_bytes,
      round(coalesce(avg(generation_time_s) filter (status = 'completed'), 0), 4) as avg_time_s,
      round(count(*) filter (status = 'completed') / 3600.0::double, 6) as devices_per_s from results""",
    ),
)
def run_summary(spark, sf):
    out = ST.run_summary(results(spark, sf), 3600.0)
    return out.withColumns({"avg_time_s": r6("avg_time_s", 4), "devices_per_s": r6("devices_per_s")})


@register(
    "failed_devices",
    with_ctes(
        RESULTS,
        """select device_id, status, (select greatest(count(*) - 20, 0) from results
        where status <> 'completed') as more from results where status <> 'completed'
      order by device_id limit 20""",
    ),
)
def failed_devices(spark, sf):
    return ST.failed(results(spark, sf), 20)


@register(
    "failure_mix",
    """select coalesce(case s_nationkey % 4 when 1 then 'bearing' when 2 then 'impeller'
      when 3 then 'radial' end, 'healthy') as failure_type, count(*) as devices
      from supplier group by 1""",
)
def failure_mix(spark, sf):
    n = F.col("s_nationkey") % 4
    typed = table(spark, sf, "supplier").select(
        F.when(n == 1, "bearing").when(n == 2, "impeller").when(n == 3, "radial").alias("failure_type")
    )
    return ST.failure_mix(typed)


@register(
    "param_ranges",
    """select 'p_size' as parameter, min(p_size)::double as lowest, max(p_size)::double as highest,
      round(avg(p_size), 6) as mean from part union all
      select 'p_retailprice', min(p_retailprice), max(p_retailprice), round(avg(p_retailprice), 6)
      from part""",
)
def param_ranges(spark, sf):
    out = ST.param_ranges(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    return out.withColumn("mean", r6("mean"))


@register(
    "fleet_sizing",
    """with r as (select cast(floor((30 + s_nationkey) * 86400.0::double / 60) as bigint) + 1 as n
      from supplier)
      select count(*) as devices, max(n) as rows_per_device,
      max(n) * 72.5::double as bytes_per_device, cast(sum(n) as bigint) as total_rows,
      cast(sum(n) as double) * 72.5::double as total_bytes from r""",
)
def fleet_sizing(spark, sf):
    days = (F.lit(30.0) + F.col("s_nationkey")).alias("duration_days")
    return ST.sizing(table(spark, sf, "supplier").select(days), 60, 72.5)


@register(
    "device_status",
    """with seen as (select l_suppkey as device_id, count(*) as n,
        count(*) filter (v is null) as bad from (select l_suppkey,
          case when l_suppkey % 5 <> 0 or l_tax > 0 then l_quantity end as v from lineitem) group by 1),
      expected as (select s_suppkey as device_id, case when s_suppkey % 3 = 0 then 10::bigint
        else coalesce(n, 1) end as e from supplier left join seen on s_suppkey = device_id)
      select e.device_id, coalesce(n, 0) as num_rows, case when n is null then 'error: no rows'
        when n <> e then printf('error: %d rows, expected %d', n, e)
        when bad > 0 then printf('error: %d rows with missing values', bad)
        else 'completed' end as status from expected e left join seen s using (device_id)""",
)
def device_status(spark, sf):
    key = F.col("l_suppkey").alias("device_id")
    value = F.when((F.col("l_suppkey") % 5 != 0) | (F.col("l_tax") > 0), F.col("l_quantity"))
    rows = table(spark, sf, "lineitem").select(key, value.alias("v"))
    counts = rows.groupBy("device_id").agg(F.count(F.lit(1)).alias("_n"))
    wanted = F.when(F.col("device_id") % 3 == 0, F.lit(10)).otherwise(F.coalesce("_n", F.lit(1)))
    manifest = (
        table(spark, sf, "supplier")
        .select(F.col("s_suppkey").alias("device_id"))
        .join(counts, "device_id", "left")
        .select("device_id", ((wanted - 1) / 1440.0).alias("duration_days"))
    )
    return ST.device_status(manifest, rows, ["v"], 60)
