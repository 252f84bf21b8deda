"""Manifest sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.draws import Draws
from ..operators import intervals as I
from ..operators import manifest as M
from ..sources import records
from .base import Registry, r6, sql_n, sql_u, table, with_ctes

register = Registry()
D = Draws(7)
PART = "'7|' || p_partkey"
KEY = ["p_partkey"]


def _parts(spark, sf):
    return table(spark, sf, "part").select("p_partkey")


QUOTA = """ranked as (select p_partkey, row_number() over (order by
    md5('{seed}|' || p_partkey || '|quota'), p_partkey) - 1 as r,
    count(*) over () as n from part),
  typed as (select p_partkey, case when r < floor(n * 0.2) then '{a}'
    when r < 2 * floor(n * 0.2) then '{b}' when r < 3 * floor(n * 0.2) then '{c}'
    end as failure_type from ranked)"""


@register(
    "quota_assignment",
    with_ctes(QUOTA.format(seed=7, a="bearing", b="impeller", c="radial"), "select * from typed"),
)
def quota_assignment(spark, sf):
    return M.assign_quota(
        _parts(spark, sf), "p_partkey", [(f, 0.2) for f in K.PUMP_FAILURES], 7
    )


@register("uniform_draw", f"select p_partkey, 2.0 + {sql_u(PART, 'a')} * 10.0 as v from part")
def uniform_draw(spark, sf):
    return _parts(spark, sf).select("p_partkey", D.uniform(KEY, "a", 2.0, 12.0).alias("v"))


@register(
    "lognormal_draw",
    f"""select p_partkey, round(least(greatest(exp(0.4 * {sql_n(PART, 'sev')}), 0.3), 3.0), 6)
      as v from part""",
)
def lognormal_draw(spark, sf):
    v = D.lognormal(KEY, "sev", 0.0, 0.4, 0.3, 3.0).alias("v")
    return _parts(spark, sf).select("p_partkey", v).withColumn("v", r6("v"))


@register(
    "exponential_draw",
    f"""select p_partkey, round(least(greatest(-2.0 * ln(1.0 - {sql_u(PART, 'freq')}), 0.0), 8.0), 6)
      + 0.0 as v from part""",
)
def exponential_draw(spark, sf):
    v = D.exponential(KEY, "freq", 2.0, 0.0, 8.0).alias("v")
    return _parts(spark, sf).select("p_partkey", v).withColumn("v", r6("v"))


@register(
    "normal_draw", f"select p_partkey, round(9.4 * {sql_n(PART, 'vo')}, 6) + 0.0 as v from part"
)
def normal_draw(spark, sf):
    v = D.normal(KEY, "vo", 0.0, 9.4).alias("v")
    return _parts(spark, sf).select("p_partkey", v).withColumn("v", r6("v"))


@register(
    "integer_draw",
    f"select p_partkey, cast(floor(1.0 + {sql_u(PART, 'n')} * 4.0) as integer) as v from part",
)
def integer_draw(spark, sf):
    return _parts(spark, sf).select("p_partkey", D.randint(KEY, "n", 1, 5).alias("v"))


def subset_sql(options, key_col, seed, n_sql, stream, source):
    """CTE ``subsets``: the n options with the lowest hashes, pipe-joined."""
    opts = ", ".join(f"('{o}')" for o in options)
    return f"""opts(o) as (values {opts}),
  hashed as (select {key_col}, o, md5('{seed}|' || {key_col} || '|{stream}|' || o) as h,
    cast({n_sql} as bigint) as n from {source}, opts),
  placed as (select *, row_number() over (partition by {key_col} order by h) as r from hashed),
  subsets as (select {key_col}, string_agg(o, '|' order by h) as decoy_types from placed
    where r <= n group by 1)"""


@register(
    "random_subset",
    with_ctes(
        subset_sql(K.PUMP_DECOYS, "p_partkey", 7, f"floor(1.0 + {sql_u(PART, 'n')} * 4.0)", "type", "part"),
        "select * from subsets",
    ),
)
def random_subset(spark, sf):
    options = F.array(*[F.lit(d) for d in K.PUMP_DECOYS])
    picked = D.subset(options, D.randint(KEY, "n", 1, 5), KEY, "type")
    return _parts(spark, sf).select("p_partkey", F.concat_ws("|", picked).alias("decoy_types"))


@register(
    "random_choice",
    f"""select p_partkey, list_extract(['highload_step', 'highload_ramp', 'bp_step', 'bp_ramp'],
      cast(floor({sql_u(PART, 'pick')} * 4) as bigint) + 1) as v from part""",
)
def random_choice(spark, sf):
    options = F.array(*[F.lit(d) for d in K.PUMP_DECOYS])
    return _parts(spark, sf).select("p_partkey", D.choice(options, KEY, "pick").alias("v"))


def poisson_sql(source, rate, days, seed, stream, prefix):
    """CTEs ending in ``{prefix}_events``: device_id, event_day, event_in_day, time_s."""
    day_key = f"'{seed}|' || device_id || '|' || event_day"
    return f"""{prefix}_days as (select device_id, _rate, _days, d as event_day,
    least(1.0, _days - d) as part from (select *, {rate} as _rate, {days} as _days from {source}),
    lateral (select unnest(range(0, cast(ceil(_days) as bigint))) as d)),
  {prefix}_cdf as (select device_id, event_day, part, {sql_u(day_key, stream + '_count')} as u,
    sum(exp(-_rate * part + j * ln(_rate * part) - lgamma(j + 1)))
      over (partition by device_id, event_day order by j) as cdf
    from {prefix}_days, range(0, 60) r(j)),
  {prefix}_n as (select device_id, event_day, part, count(*) filter (cdf <= u) as n
    from {prefix}_cdf group by all),
  {prefix}_no as (select device_id, event_day, part, unnest(range(1, n + 1)) as event_in_day
    from {prefix}_n),
  {prefix}_events as (select device_id, event_day, event_in_day, (event_day + part *
    {sql_u(day_key + " || '|' || event_in_day", stream + '_time')}) * 86400.0 as time_s
    from {prefix}_no)"""


DEVICES = """devices as (select s_suppkey as device_id,
    1.0::double + (s_nationkey % 3) * 0.5::double as days, s_nationkey from supplier)"""


def devices(spark, sf):
    """Suppliers as devices: 1 to 2 days each."""
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("device_id"),
        (F.lit(1.0) + (F.col("s_nationkey") % 3) * 0.5).alias("days"),
        "s_nationkey",
    )


@register(
    "poisson_events",
    with_ctes(
        DEVICES,
        poisson_sql("devices", "(0.5 + s_nationkey * 0.25::double)", "days", 7, "visit", "p"),
        """select device_id, event_day, cast(event_in_day as integer) as event_in_day,
      round(time_s, 5) as time_s from p_events""",
    ),
)
def poisson_events(spark, sf):
    out = I.poisson_events(
        devices(spark, sf), F.lit(0.5) + F.col("s_nationkey") * 0.25, F.col("days"), D, "visit"
    )
    return out.select("device_id", "event_day", "event_in_day", r6("time_s", 5).alias("time_s"))


@register(
    "device_ids",
    "select p_partkey, printf('device_%06d', p_partkey) as device_id, 12345 + p_partkey as seed from part",
)
def device_ids(spark, sf):
    return M.device_ids(_parts(spark, sf), "p_partkey", "device", K.FLEET_SEED)


SUPP = "'7|' || s_suppkey"


@register(
    "conditional_defaults",
    f"""select s_suppkey,
      case when s_acctbal < 0 then s_acctbal end as only_negative,
      coalesce(case when s_nationkey % 2 = 0 then s_nationkey * 1.0::double end,
        365.0::double * (0.7 + {sql_u(SUPP, 'default_start')} * (0.9::double - 0.7::double))) as start_day,
      case when s_nationkey % 5 = 0 then 0.5 + {sql_u(SUPP, 'default_severity')} * 1.5
        else s_nationkey % 5 end as severity from supplier""",
)
def conditional_defaults(spark, sf):
    nat = F.col("s_nationkey")
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        M.only_if(F.col("s_acctbal") < 0, F.col("s_acctbal")).alias("only_negative"),
        M.default_start_day(F.when(nat % 2 == 0, nat * 1.0), F.lit(365.0), ["s_suppkey"], D).alias(
            "start_day"
        ),
        M.default_severity((nat % 5).cast("double"), ["s_suppkey"], D).alias("severity"),
    )


def manifest_sql(prefix, types, decoys, v_nom, extra=""):
    k = "'12345|' || p_partkey"
    return with_ctes(
        QUOTA.format(seed=12345, a=types[0], b=types[1], c=types[2]),
        subset_sql(
            decoys, "p_partkey", 12345, f"floor(1.0 + {sql_u(k, 'decoy_n')} * {len(decoys)}.0)",
            "decoy_type", "part",
        ),
        f"""select printf('{prefix}_%06d', p_partkey) as device_id, 12345 + p_partkey as seed,
      90.0::double as duration_days, failure_type,
      case when failure_type is not null then
        round(27.0 + {sql_u(k, 'start')} * (85.5 - 27.0), 6) end as failure_start_day,
      round(least(greatest(exp(0.4 * {sql_n(k, 'severity')}), 0.3), 3.0), 6) as failure_severity,
      round(2.0 + {sql_u(k, 'ambient')} * 10.0, 6) as "ambient_var_K",
      round(0.1 + {sql_u(k, 'duty')} * 0.7, 6) as duty_cycle_var,
      round(least(greatest(-2.0 * ln(1.0 - {sql_u(k, 'decoy_freq')}), 0.0), 8.0), 6) + 0.0
        as decoy_freq_per_day,
      decoy_types, round(0.5 + {sql_u(k, 'noise')} * 1.5, 6) as noise_scale,
      round({v_nom * 0.02} * {sql_n(k, 'v_offset')}, 6) + 0.0 as v_offset{extra.format(
          n=sql_n(k, 'p_offset'))}
      from typed join subsets using (p_partkey)""",
    )


def _manifest(spark, sf, machine):
    out = M.sample_manifest(_parts(spark, sf), "p_partkey", machine, 90.0)
    out = out.withColumn("decoy_types", F.concat_ws("|", "decoy_types")).drop("p_partkey")
    doubles = [c for c, t in out.dtypes if t == "double" and c not in ("duration_days", "p_offset")]
    out = out.withColumns({c: r6(c) for c in doubles})
    return out.withColumn("p_offset", r6("p_offset", 4)) if machine == "pump" else out


@register(
    "pump_manifest",
    manifest_sql(
        "device", K.PUMP_FAILURES, K.PUMP_DECOYS, K.PUMP_V_NOM,
        ", round(27859.62 * {n}, 4) + 0.0 as p_offset",
    ),
)
def pump_manifest(spark, sf):
    return _manifest(spark, sf, "pump")


@register(
    "motor_manifest", manifest_sql("motor", K.MOTOR_FAILURES, K.MOTOR_DECOYS, K.MOTOR_V_NOM)
)
def motor_manifest(spark, sf):
    return _manifest(spark, sf, "motor")
