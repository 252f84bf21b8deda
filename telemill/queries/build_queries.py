"""Building series: spine, tiling, modulation, event windows and overlays."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import curves as C
from ..functions import derive as DV
from ..functions.draws import Draws
from ..operators import intervals as I
from ..operators import labels as L
from ..operators import lut as LU
from ..operators import modulate as MO
from ..operators import overlay as O
from ..operators import spine as S
from .base import TELE, Registry, micros, r6, sql_n, sql_u, table, tele, with_ctes
from .draw_queries import DEVICES, devices, poisson_sql

register = Registry()
D = Draws(11)
FREQ = 300
STARTUP, CYCLE = 80, 20
#: 2024-01-15, the middle of the events' month.
MIDDLE_US = 1_705_276_800_000_000
ROW_KEY = "'11|' || device_id || '|' || row_i"

# -- inputs taken from the tables -------------------------------------------

GRID = DEVICES + f""",
  grid as (select device_id, days, s_nationkey, row_i, row_i * {FREQ} as time_s,
    row_i * {FREQ} / 3600.0::double as time_h from (select *, unnest(range(0,
    cast(floor(days * 86400 / {FREQ}.0) as bigint) + 1)) as row_i from devices))"""


def grid(spark, sf):
    return S.spine(devices(spark, sf), FREQ, "days")


def rounded(df, cols, *keep, digits=6):
    return df.select(*keep, *[r6(c, digits).alias(c) for c in cols])


def sql_rounded(cols, digits=6, source=""):
    return ", ".join(f"round({source}{c}, {digits}) + 0.0 as {c}" for c in cols)


SIGNALS = ["speed", "flow", "temp_K", "wear"]
SD = {"speed": 0.3, "flow": 0.005, "temp_K": 0.2, "wear": 0.0}
SIGNAL_SQL = """avg(l_quantity) * 10 as speed, avg(l_discount) as flow,
    290 + avg(l_tax) * 500 as "temp_K", avg(l_linenumber) as wear"""
PROFILE = f"""profile as (select case when i < {STARTUP} then 'startup' else 'cycle' end as phase,
    case when i < {STARTUP} then i else i - {STARTUP} end as idx, speed, flow, "temp_K", wear
    from (select l_orderkey % {STARTUP + CYCLE} as i, {SIGNAL_SQL} from lineitem group by 1))"""


def _signals():
    return [
        (F.avg("l_quantity") * 10).alias("speed"),
        F.avg("l_discount").alias("flow"),
        (F.lit(290) + F.avg("l_tax") * 500).alias("temp_K"),
        F.avg("l_linenumber").alias("wear"),
    ]


def profile(spark, sf):
    """Mean order lines by position as the measured profile of a machine."""
    i = F.col("i")
    by = table(spark, sf, "lineitem").groupBy((F.col("l_orderkey") % (STARTUP + CYCLE)).alias("i"))
    return by.agg(*_signals()).select(
        F.when(i < STARTUP, "startup").otherwise("cycle").alias("phase"),
        F.when(i < STARTUP, i).otherwise(i - STARTUP).alias("idx"),
        *SIGNALS,
    )


TILED = GRID + ", " + PROFILE + f""",
  tiled as (select g.*, p.speed, p.flow, p."temp_K", p.wear from grid g join profile p
    on p.phase = case when row_i < {STARTUP} then 'startup' else 'cycle' end
    and p.idx = case when row_i < {STARTUP} then row_i else (row_i - {STARTUP}) % {CYCLE} end),
  means as (select avg(speed) as m_speed, avg(flow) as m_flow, avg("temp_K") as "m_temp_K",
    avg(wear) as m_wear from profile where phase = 'cycle')"""
NOISY_COLS = ", ".join(
    f'"{c}" + {sd} * {sql_n(ROW_KEY, "noise_" + c)} as "{c}"' for c, sd in SD.items() if sd
)
BASE = TILED + f""",
  base as materialized (select device_id, days, s_nationkey, row_i, time_s, time_h, {NOISY_COLS}, wear
    from tiled)"""


def tiled(spark, sf):
    return S.tile(grid(spark, sf), profile(spark, sf), SIGNALS, STARTUP, CYCLE)


def base(spark, sf):
    """Tiled profile with noise: the series that events are laid over."""
    df = MO.add_noise(tiled(spark, sf), SD, D)
    return df.select("device_id", "days", "s_nationkey", "row_i", "time_s", "time_h", *SIGNALS)


KEYS = ["device_id", "row_i"]
OUT = sql_rounded(["speed", "flow", '"temp_K"', "wear"])

# -- spine and tiling --------------------------------------------------------


@register("time_spine", with_ctes(GRID, "select device_id, row_i, time_s, time_h from grid"))
def time_spine(spark, sf):
    return grid(spark, sf).select("device_id", "row_i", "time_s", "time_h")


@register(
    "template_extract",
    with_ctes(
        TELE,
        """n as (select device_id, max(row_i) + 1 as n from tele group by 1)
      select t.device_id, 'startup' as phase, row_i as idx, x from tele t where row_i < 20
      union all select t.device_id, 'cycle', row_i - greatest(n - 5, 0), x
      from tele t join n using (device_id) where row_i >= n - 5""",
    ),
)
def template_extract(spark, sf):
    df = tele(spark, sf).select("device_id", "row_i", "x")
    return S.extract_template(df, 5).select("device_id", "phase", "idx", "x")


@register("template_tile", with_ctes(TILED, f"select device_id, row_i, {OUT} from tiled"))
def template_tile(spark, sf):
    return rounded(tiled(spark, sf), SIGNALS, *KEYS)


@register(
    "constant_baseline",
    with_ctes(
        GRID,
        f"""level as (select {SIGNAL_SQL} from lineitem where l_returnflag = 'N')
      select device_id, row_i, {OUT} from grid, level""",
    ),
)
def constant_baseline(spark, sf):
    healthy = table(spark, sf, "lineitem").where("l_returnflag = 'N'").agg(*_signals())
    return rounded(S.baseline(grid(spark, sf), healthy), SIGNALS, *KEYS)


# -- modulation --------------------------------------------------------------


@register("signal_noise", with_ctes(BASE, f"select device_id, row_i, {OUT} from base"))
def signal_noise(spark, sf):
    return rounded(base(spark, sf), SIGNALS, *KEYS)


def drift_sql(cols, source, key=ROW_KEY, sd=0.001, part="device_id"):
    return ", ".join(
        f"""round("{c}" + sum({sd} * {sql_n(key, 'drift_' + c)})
      over (partition by {part} order by row_i), 6) + 0.0 as "{c}" """
        for c in cols
    )


@register(
    "random_drift",
    with_ctes(TILED, f"select device_id, row_i, {drift_sql(['temp_K', 'speed'], 'tiled')} from tiled"),
)
def random_drift(spark, sf):
    df = tiled(spark, sf).select(*KEYS, "temp_K", "speed")
    out = MO.add_drift(df, ["temp_K", "speed"], 0.001, D, chunk_rows=96)
    return rounded(out, ["temp_K", "speed"], *KEYS)


AMBIENT = """-5.0 * cos(6.283185307179586 * (time_h - 4) / 24) -
  2.5 * cos(6.283185307179586 * (time_h / 24) / 365)"""


@register(
    "ambient_temperature",
    with_ctes(
        TILED, f"""select device_id, row_i, round("temp_K" + {AMBIENT}, 6) as "temp_K" from tiled"""
    ),
)
def ambient_temperature(spark, sf):
    return rounded(MO.add_ambient(tiled(spark, sf), ["temp_K"], 5.0), ["temp_K"], *KEYS)


COUPLED = """(0.05 * sin(6.283185307179586 * (time_h - 14) / 24) +
  0.025 * sin(6.283185307179586 * time_h / 8760))"""


@register(
    "ambient_resistance",
    with_ctes(
        TILED,
        f"""select device_id, row_i, round(wear + {COUPLED}, 6) + 0.0 as wear,
      round(speed - 10 * {COUPLED}, 6) + 0.0 as speed from tiled""",
    ),
)
def ambient_resistance(spark, sf):
    out = MO.add_ambient_coupled(tiled(spark, sf), "wear", "speed", 5.0)
    return rounded(out, ["wear", "speed"], *KEYS)


DEPTH = "(0.1 + s_nationkey * 0.02::double)"
WEEKEND = f"case when floor(time_h / 24) % 7 >= 5 then 1 - 0.3 * {DEPTH} else 1.0 end"
SMOOTH = f"""(1 - case when hour >= 6 and hour < 18 then 0.0 else 0.6 * {DEPTH} end
  * (1 - least(greatest((hour - 5) / 2, 0), 1) * least(greatest((19 - hour) / 2, 0), 1))) * {WEEKEND}"""
STEPPED = f"(case when hour >= 6 and hour < 18 then 1.0 else 1 - 0.4 * {DEPTH} end) * {WEEKEND}"


# Nine days and more of every device, so that a weekend and a second week are in.
LONG = TILED.replace("days * 86400", "(days + 9) * 86400")


def long_tiled(spark, sf):
    days = devices(spark, sf).withColumn("days", F.col("days") + 9)
    return S.tile(S.spine(days, FREQ, "days"), profile(spark, sf), SIGNALS, STARTUP, CYCLE)


def depth():
    return F.lit(0.1) + F.col("s_nationkey") * 0.02


@register(
    "duty_smooth",
    with_ctes(
        LONG,
        f"""hours as (select *, time_h - 24 * floor(time_h / 24) as hour from tiled)
      select device_id, row_i, round(m_speed + (speed - m_speed) * {SMOOTH}, 6) as speed,
      round(m_flow + (flow - m_flow) * {SMOOTH}, 6) as flow from hours, means""",
    ),
)
def duty_smooth(spark, sf):
    means = S.template_mean(profile(spark, sf), ["speed", "flow"])
    df = S.with_one_row(long_tiled(spark, sf), means)
    out = MO.add_duty(df, {"speed": "mean_speed", "flow": "mean_flow"}, depth(), 0.6, True)
    return rounded(out, ["speed", "flow"], *KEYS)


@register(
    "duty_stepped",
    with_ctes(
        LONG,
        f"""hours as (select *, time_h - 24 * floor(time_h / 24) as hour,
        avg(speed) over (partition by device_id) as mine from tiled)
      select device_id, row_i, round(mine + (speed - mine) * {STEPPED}, 6) as speed from hours""",
    ),
)
def duty_stepped(spark, sf):
    df = MO.with_series_mean(long_tiled(spark, sf), ["speed"])
    return rounded(MO.add_duty(df, {"speed": "mean_speed"}, depth(), 0.4, False), ["speed"], *KEYS)


@register(
    "pump_offsets",
    with_ctes(
        TILED,
        """select device_id, row_i, round(speed + (s_nationkey - 12) * 0.8::double, 6) as speed,
      round(flow + flow * ((s_nationkey - 12) * 1000.0 / 928654.0::double), 6) as flow from tiled""",
    ),
)
def pump_offsets(spark, sf):
    off = F.col("s_nationkey") - 12.0
    out = MO.apply_pump_offsets(tiled(spark, sf), ["speed"], ["flow"], off, off * 1000.0)
    return rounded(out, ["speed", "flow"], *KEYS)


# -- curves ------------------------------------------------------------------

LUT = """lut as (select 'size' as axis, p_size::double as param, avg(p_retailprice) as price,
    avg(length(p_name)) as name_len from part group by p_size)"""


def lut(spark, sf):
    return table(spark, sf, "part").groupBy("p_size").agg(
        F.avg("p_retailprice").alias("price"), F.avg(F.length("p_name")).alias("name_len")
    ).select(F.lit("size").alias("axis"), F.col("p_size").cast("double").alias("param"), "price", "name_len")


SEGMENTS = """segs as (select param as p0, lead(param) over (order by param) as p1, price as a0,
    lead(price) over (order by param) as a1, name_len as b0,
    lead(name_len) over (order by param) as b1 from lut),
  ends as (select min(param) as lo, max(param) as hi from lut)"""


@register(
    "curve_interpolation",
    with_ctes(
        LUT,
        SEGMENTS,
        """x as (select event_id, least(greatest(value, lo), hi) as v from events, ends)
      select event_id, round(a0 + (a1 - a0) * (v - p0) / (p1 - p0), 6) as price,
      round(b0 + (b1 - b0) * (v - p0) / (p1 - p0), 6) as name_len
      from x join segs on v >= p0 and (v < p1 or (v = p1 and p1 = (select hi from ends)))""",
    ),
)
def curve_interpolation(spark, sf):
    x = table(spark, sf, "events").select("event_id", "value", F.lit("size").alias("axis"))
    out = LU.interp(x, lut(spark, sf), "value", ["price", "name_len"], prefix="at_")
    return out.select("event_id", r6("at_price").alias("price"), r6("at_name_len").alias("name_len"))


@register(
    "motor_offsets",
    with_ctes(
        TILED,
        LUT,
        SEGMENTS,
        """shift as (select device_id, a0 + (a1 - a0) * (v - p0) / (p1 - p0) - (select price from lut
        where param = 25) as d from (select device_id, 25 + (s_nationkey - 12) * 0.5::double as v
        from devices) join segs on v >= p0 and v < p1)
      select t.device_id, t.row_i, round(speed + d, 6) as speed from tiled t join shift using (device_id)""",
    ),
)
def motor_offsets(spark, sf):
    curve = lut(spark, sf)
    per_device = devices(spark, sf).select(
        "device_id",
        F.lit("size").alias("axis"),
        (F.lit(25.0) + (F.col("s_nationkey") - 12) * 0.5).alias("volts"),
        F.lit(25.0).alias("nominal"),
    )
    at = LU.interp(per_device, curve, "volts", ["price"], prefix="at_")
    at = LU.interp(at, curve, "nominal", ["price"], prefix="nom_")
    shift = at.select("device_id", (F.col("at_price") - F.col("nom_price")).alias("shift"))
    out = MO.attach(tiled(spark, sf), shift, ["device_id"])
    return rounded(out.withColumn("speed", F.col("speed") + F.col("shift")), ["speed"], *KEYS)


WEAR = "((exp(3 * least(time_s / {span}, 1.0)) - 1) / (exp(3.0::double) - 1))"


@register(
    "degradation_curve",
    with_ctes(
        GRID,
        f"""select device_id, row_i, round(case when s_nationkey = 0 then 0.3 else 0.081 +
      (0.3 - 0.081) * {WEAR.format(span='(s_nationkey * 3600.0::double)')} end, 6) as wear from grid""",
    ),
)
def degradation_curve(spark, sf):
    span = F.col("s_nationkey") * 3600.0
    df = grid(spark, sf).withColumn("wear", C.degrade(F.col("time_s"), 0.081, 0.3, span))
    return rounded(df, ["wear"], *KEYS)


@register(
    "input_schedules",
    with_ctes(
        GRID,
        """select device_id, row_i, case when t < 1800 then 471.2389
        when t < 1900 then 471.2389 + (t - 1800) when t < 3500 then 571.2389
        else 471.2389 - (t - 3600) end as cyclic,
      case when time_s >= 7200 then 1200000.0 else 928654.0 end as step,
      round(928654.0 + least(greatest((time_s - 7200) / 7200.0::double, 0), 1)
        * (1200000.0 - 928654.0), 6) as ramp
      from (select *, time_s % 3600 as t from grid)""".replace("471.2389", "471.2389::double")
        .replace("571.2389", "571.2389::double").replace("928654.0", "928654.0::double")
        .replace("1200000.0", "1200000.0::double"),
    ),
)
def input_schedules(spark, sf):
    t = F.col("time_s")
    lo, hi = K.PUMP_P_DISCHARGE, K.PUMP_P_DISCHARGE_HIGH
    return grid(spark, sf).select(
        *KEYS,
        C.cyclic(t).alias("cyclic"),
        C.step(t, lo, hi).alias("step"),
        F.round(C.ramp(t, lo, hi), 6).alias("ramp"),
    )


@register(
    "steady_state",
    """with runs as (select l_suppkey, row_number() over (partition by l_suppkey
        order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 as row_i, l_quantity, l_discount,
        l_tax from lineitem),
      n as (select *, count(*) over (partition by l_suppkey) as n,
        count(*) filter (row_i >= 580) over (partition by l_suppkey) as late from runs)
      select l_suppkey, round(avg(l_quantity), 6) as v_rot,
      round(sqrt(avg(l_quantity * l_quantity + l_discount * l_discount + l_tax * l_tax)), 6) as i_rms
      from n where case when late >= 2 then row_i >= 580 else row_i >= n // 2 end group by 1""",
)
def steady_state(spark, sf):
    from ..operators.chunks import with_row_index

    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax",
    )
    runs = with_row_index(
        lines, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    )
    out = LU.steady_state(
        runs, "l_suppkey", "row_i", "l_quantity", ["l_quantity", "l_discount", "l_tax"], 580
    )
    return rounded(out, ["v_rot", "i_rms"], "l_suppkey")


@register(
    "calibration_table",
    """select 'size' as axis, round(1.0 + i * (49.0::double / 14), 6) as param,
      round(avg(p_retailprice), 6) as price from (select p_retailprice,
        floor((p_size - 1) / (49.0::double / 14) + 0.5) as i from part) where i between 0 and 14 group by i""",
)
def calibration_table(spark, sf):
    points = table(spark, sf, "part").withColumnRenamed("p_retailprice", "price")
    out = LU.build_lut(points, "p_size", ["price"], 1.0, 50.0, "size")
    return rounded(out, ["param", "price"], "axis")


# -- derivations -------------------------------------------------------------


@register(
    "flow_gap",
    """select l_orderkey as time_s, l_orderkey / 3600.0::double as time_h, l_quantity as shaft_speed_rads,
      l_quantity as pump_speed_rads, l_tax as flow_in_m3s, l_discount as flow_out_m3s,
      greatest(l_tax - l_discount, 0.0) as flow_gap_m3s from lineitem""",
)
def flow_gap(spark, sf):
    df = DV.rename(
        table(spark, sf, "lineitem"),
        {
            "l_orderkey": "time_s",
            "l_quantity": "shaft_speed_rads",
            "l_tax": "flow_in_m3s",
            "l_discount": "flow_out_m3s",
        },
    )
    return DV.with_pump_columns(df)


@register(
    "power_derivation",
    """select l_orderkey, l_linenumber, l_partkey, round(0.001 * l_quantity * l_quantity, 6) as "torque_load_Nm",
      round(0.001 * l_quantity * l_quantity * abs(l_quantity), 6) as "mechanical_power_W",
      round(23.0 * l_tax, 6) as "electrical_power_W" from lineitem""",
)
def power_derivation(spark, sf):
    df = DV.with_power(table(spark, sf, "lineitem"), "l_quantity", "l_tax", 23.0, 0.001)
    return rounded(
        df,
        ["torque_load_Nm", "mechanical_power_W", "electrical_power_W"],
        "l_orderkey", "l_linenumber", "l_partkey",
    )


@register(
    "schema_rename",
    """select l_quantity as shaft_speed_rads, l_tax as "thrust_bearing_K",
      l_extendedprice as flow_out_m3s from lineitem""",
)
def schema_rename(spark, sf):
    return DV.rename(
        table(spark, sf, "lineitem"),
        {
            "l_quantity": "shaft_speed_rads",
            "l_tax": "thrust_bearing_K",
            "l_extendedprice": "flow_out_m3s",
        },
    )


# -- event windows -----------------------------------------------------------

WHO = "'11|' || device_id || '|' || event_day || '|' || event_in_day"


def schedule_sql(kind, rate, lo, hi, types=None, amplitude=None, episode=None, seed=11):
    """CTE ``{kind}s``: proposed windows that end before the series does."""
    who = WHO.replace("'11|'", f"'{seed}|'")
    hours = f"({lo}::double + {sql_u(who, kind + '_hours')} * ({hi}::double - {lo}::double))"
    end = "proposed_end" if episode is None else f"least(proposed_end, start_row + {episode})"
    name = f"'{kind}'"
    if types:
        opts = ", ".join(f"'{t}'" for t in types)
        pick = f"cast(floor({sql_u(who, kind + '_type')} * {len(types)}) as bigint) + 1"
        name = f"'{kind}_' || list_extract([{opts}], {pick})"
    strength = ""
    if amplitude:
        a, b = amplitude
        strength = f""", {a}::double + {sql_u(who, kind + '_amplitude')}
          * ({b}::double - {a}::double) as amplitude"""
    return (
        poisson_sql("devices", rate, "days", seed, kind, kind)
        + f""",
  {kind}_p as (select *, cast(floor(time_s / {FREQ}) as bigint) as start_row,
    cast(floor(time_s / {FREQ}) as bigint) + cast(floor({hours} * 3600.0::double / {FREQ}) as bigint)
      as proposed_end, {name} as kind{strength} from {kind}_events),
  {kind}s as (select p.*, {end} as end_row from {kind}_p p join devices d
    on d.device_id = p.device_id and proposed_end < floor(d.days * 86400.0 / {FREQ}) + 1
    and proposed_end > start_row)"""
    )


def walk_sql(source, out):
    """CTEs: greedy walk in time order."""
    return f"""{out}_o as (select *, row_number() over (partition by device_id
    order by start_row, event_day, event_in_day) as rn from {source}),
  {out}_r as (select *, end_row as reached, true as free from {out}_o where rn = 1 union all
    select o.*, case when o.start_row >= r.reached then o.end_row else r.reached end,
      o.start_row >= r.reached from {out}_r r join {out}_o o
      on o.device_id = r.device_id and o.rn = r.rn + 1),
  {out} as materialized (select * exclude (rn, reached, free) from {out}_r where free)"""


WINDOW = ["device_id", "event_day", "event_in_day", "start_row", "end_row"]
MAINT_SQL = schedule_sql("maintenance", "2.0", 1.0, 3.0)
TYPES = ["highload_step", "highload_ramp", "bp_step", "bp_ramp"]
DECOY_SQL = schedule_sql("decoy", "6.0", 1.0, 6.0, TYPES, (0.4, 1.6), 48)


def maintenance(spark, sf):
    return I.schedule(devices(spark, sf), "maintenance", D, FREQ, F.lit(2.0), (1.0, 3.0), "days")


def decoys(spark, sf):
    return I.schedule(
        devices(spark, sf), "decoy", D, FREQ, F.lit(6.0), (1.0, 6.0), "days",
        F.array(*[F.lit(t) for t in TYPES]), (0.4, 1.6), 48,
    )


@register(
    "maintenance_schedule",
    with_ctes(
        DEVICES,
        MAINT_SQL,
        """select device_id, event_day, cast(event_in_day as integer) as event_in_day, start_row,
      end_row, kind from maintenances""",
    ),
)
def maintenance_schedule(spark, sf):
    return maintenance(spark, sf).select(*WINDOW, "kind")


@register(
    "decoy_schedule",
    with_ctes(
        DEVICES,
        DECOY_SQL,
        """select device_id, event_day, cast(event_in_day as integer) as event_in_day, start_row,
      end_row, proposed_end, kind, round(amplitude, 6) as amplitude from decoys""",
    ),
)
def decoy_schedule(spark, sf):
    return decoys(spark, sf).select(*WINDOW, "proposed_end", "kind", r6("amplitude").alias("amplitude"))


KEPT_SQL = (
    MAINT_SQL
    + ", "
    + walk_sql("maintenances", "kept_m")
    + ", "
    + DECOY_SQL
    + """,
  clear as (select * from decoys d where not exists (select 1 from kept_m m
    where m.device_id = d.device_id and d.start_row < m.end_row and m.start_row < d.proposed_end)), """
    + walk_sql("clear", "kept_d")
)


def kept(spark, sf):
    """Maintenance windows first, then the decoys that fit between them."""
    return I.fit_windows(maintenance(spark, sf), decoys(spark, sf), (FREQ, 86400))


@register(
    "window_scheduling",
    with_ctes(
        DEVICES,
        KEPT_SQL,
        """select device_id, start_row, end_row, kind from kept_m union all
      select device_id, start_row, end_row, kind from kept_d""",
        recursive=True,
    ),
)
def window_scheduling(spark, sf):
    m, d = kept(spark, sf)
    cols = ["device_id", "start_row", "end_row", "kind"]
    return m.select(*cols).unionByName(d.select(*cols))


@register(
    "window_non_overlap",
    f"""with recursive t as (select *, epoch_us(ts) - {MIDDLE_US} as us from events),
      o as (select user_id as device_id, event_id, us as start_us,
        us + cast(round(value * 1e9) as bigint) as end_us,
        row_number() over (partition by user_id order by us, event_id) as rn from t
        where round(value * 1e9) > 0),
      r as (select *, end_us as reached, true as free from o where rn = 1 union all
        select o.*, case when o.start_us >= r.reached then o.end_us else r.reached end,
          o.start_us >= r.reached from r join o on o.device_id = r.device_id and o.rn = r.rn + 1)
      select device_id, event_id, start_us, end_us from r where free""",
)
def window_non_overlap(spark, sf):
    """Starts count from the middle of the events' month, so they lie on both sides of 0."""
    start = micros("ts") - F.lit(MIDDLE_US)
    windows = table(spark, sf, "events").select(
        F.col("user_id").alias("device_id"),
        "event_id",
        start.alias("start_us"),
        (start + F.round(F.col("value") * 1e9).cast("bigint")).alias("end_us"),
    ).where("end_us > start_us")
    return I.non_overlapping(
        windows, "device_id", "start_us", "end_us", ["event_id"], (1, 86_400_000_000)
    )


PRIORITY = ["maintenance", "decoy", "failure", "post_failure", "startup"]
FAIL_WINDOWS = """fails as (select device_id, cast(floor(days * 100) as bigint) as start_row,
    cast(floor(days * 100) as bigint) + 60 as end_row from devices where s_nationkey > 8),
  all_windows as (select device_id, start_row, end_row, kind, 0 as p from kept_m
    union all select device_id, start_row, end_row, kind, 1 from kept_d
    union all select device_id, start_row, end_row, 'failure_bearing', 2 from fails
    union all select device_id, end_row, end_row + 40, 'post_failure', 3 from fails
    union all select device_id, end_row + 30, end_row + 60, 'startup', 4 from fails)"""


def failures(spark, sf):
    start = F.floor(F.col("days") * 100)
    return devices(spark, sf).where("s_nationkey > 8").select(
        "device_id", start.alias("start_row"), (start + 60).alias("end_row"), "s_nationkey", "days"
    )


@register(
    "event_precedence",
    with_ctes(
        GRID,
        KEPT_SQL,
        FAIL_WINDOWS,
        """select g.device_id, g.row_i, coalesce(max(row(w.p, w.start_row, w.end_row, w.kind))[4], 'normal') as event_type
      from grid g left join all_windows w on g.device_id = w.device_id
        and g.row_i >= w.start_row and g.row_i < w.end_row group by 1, 2""",
        recursive=True,
    ),
)
def event_precedence(spark, sf):
    m, d = kept(spark, sf)
    f = failures(spark, sf)
    cols = ["device_id", "start_row", "end_row", "kind"]
    down = f.select(
        "device_id", F.col("end_row").alias("start_row"), (F.col("end_row") + 40).alias("end_row"),
        F.lit("post_failure").alias("kind"),
    )
    up = f.select(
        "device_id", (F.col("end_row") + 30).alias("start_row"), (F.col("end_row") + 60).alias("end_row"),
        F.lit("startup").alias("kind"),
    )
    windows = m.select(*cols).unionByName(d.select(*cols)).unionByName(
        f.withColumn("kind", F.lit("failure_bearing")).select(*cols)
    ).unionByName(down).unionByName(up)
    rows = grid(spark, sf).select(*KEYS)
    return I.resolve_events(rows, windows, PRIORITY, bucket=(FREQ, 86400))


# -- overlays ----------------------------------------------------------------


def ease_sql(r, n):
    return f"(0.5 * (1 - cos(3.141592653589793 * ({r}) / ({n}))))"


def overlay_sql(values, joins):
    """Select of the base series with the signals of event rows replaced."""
    cols = ", ".join(
        f'round(case when w.start_row is null then b."{c}" else {values.get(c, chr(34) + c + chr(34))} end, 6)'
        f' + 0.0 as "{c}"'.replace(f'else "{c}"', f'else b."{c}"')
        for c in SIGNALS
    )
    return f"select b.device_id, b.row_i, {cols} from base b {joins}"


R = "(b.row_i - w.start_row)"
N = "(w.end_row - w.start_row)"
RAMP = f"least(30, {N} // 4)"


def noise_sql(stream, c, sd, row="b.row_i"):
    return f"{sd} * {sql_n(f'{chr(39)}11|{chr(39)} || b.device_id || {chr(39)}|{chr(39)} || {row}', f'{stream}_{c}')}"


def _stopped(c):
    return f"""case when {R} < {RAMP} then pre."{c}" * (1 - {ease_sql(R, RAMP)})
      when {R} >= {N} - {RAMP} then post."{c}" * {ease_sql(f'{R} - ({N} - {RAMP})', RAMP)}
      else {noise_sql('event', c, SD[c] * 0.3)} end"""


SHUTDOWN = {
    "speed": _stopped("speed"),
    "flow": _stopped("flow"),
    "temp_K": f"""case when {R} < {RAMP} then 290 + (pre."temp_K" - 290) * (1 - {ease_sql(R, RAMP)})
      when {R} >= {N} - {RAMP} then 290 + (post."temp_K" - 290)
        * {ease_sql(f'{R} - ({N} - {RAMP})', RAMP)}
      else 290 + (pre."temp_K" - 290) * (1 - {ease_sql(f'{RAMP} - 1', RAMP)})
        * exp(-({R} - {RAMP}) / 24.0::double) + {noise_sql('event', 'temp_K', 0.2 * 0.3)} end""",
}
STOPPED, COOLED = {"speed": 0.3, "flow": 0.005}, {"temp_K": 0.2}
IN_WINDOW = "b.device_id = w.device_id and b.row_i >= w.start_row and b.row_i < w.end_row"
PRE = "left join base pre on pre.device_id = w.device_id and pre.row_i = w.start_row"


@register(
    "shutdown_overlay",
    with_ctes(
        BASE,
        MAINT_SQL,
        walk_sql("maintenances", "kept_m"),
        overlay_sql(
            SHUTDOWN,
            f"""left join kept_m w on {IN_WINDOW} {PRE}
        left join base post on post.device_id = w.device_id and post.row_i = w.end_row""",
        ),
        recursive=True,
    ),
)
def shutdown_overlay(spark, sf):
    m = I.non_overlapping(maintenance(spark, sf), bucket=(FREQ, 86400))
    out = O.overlay_shutdown(base(spark, sf), m, STOPPED, COOLED, FREQ, D, bucket=(FREQ, 86400))
    return rounded(out, SIGNALS, *KEYS)


EPISODES = f"""episodes as materialized (select case l_linestatus when 'O' then 'decoy_' || t
      else 'failure_' || f end as kind, idx, avg(speed) as speed, avg(flow) as flow,
      avg("temp_K") as "temp_K", avg(wear) as wear
    from (select l_linestatus, l_linenumber, l_orderkey % 48 as idx, {SIGNAL_SQL} from lineitem
      group by 1, 2, 3)
    join (values (1, 'highload_step', 'bearing'), (2, 'highload_ramp', 'impeller'), (3, 'bp_step', 'radial'),
      (4, 'bp_ramp', 'bearing'), (5, 'highload_step', 'impeller'), (6, 'highload_ramp', 'radial'),
      (7, 'bp_step', 'bearing')) v(n, t, f) on n = l_linenumber group by 1, 2)"""


def episodes(spark, sf):
    """Mean order lines by position as recorded decoy and failure episodes."""
    first = (
        table(spark, sf, "lineitem")
        .groupBy("l_linestatus", "l_linenumber", (F.col("l_orderkey") % 48).alias("idx"))
        .agg(*_signals())
    )
    n = F.col("l_linenumber").cast("int")
    decoy = F.array(*[F.lit(f"decoy_{t}") for t in (TYPES + TYPES)[:7]])
    fail = F.array(*[F.lit(f"failure_{K.PUMP_FAILURES[i % 3]}") for i in range(7)])
    kind = F.when(F.col("l_linestatus") == "O", F.element_at(decoy, n)).otherwise(F.element_at(fail, n))
    return first.groupBy(kind.alias("kind"), "idx").agg(*[F.avg(c).alias(c) for c in SIGNALS])


@register(
    "episode_scaling",
    with_ctes(
        PROFILE,
        EPISODES,
        f"""means as (select avg(speed) as m_speed, avg(flow) as m_flow, avg("temp_K") as "m_temp_K",
        avg(wear) as m_wear from profile where phase = 'cycle')
      select kind, idx, {", ".join(f'round("m_{c}" + 0.7 * ("{c}" - "m_{c}"), 6) as "{c}"'
                                   for c in SIGNALS)} from episodes, means""",
    ),
)
def episode_scaling(spark, sf):
    df = S.with_one_row(episodes(spark, sf), S.template_mean(profile(spark, sf), SIGNALS))
    out = df.withColumns(
        {c: O.scale_episode(F.col(c), F.col(f"mean_{c}"), F.lit(0.7)) for c in SIGNALS}
    )
    return rounded(out, SIGNALS, "kind", "idx")


def _spliced(c):
    m = f'"m_{c}"'
    now = f'({m} + w.amplitude * (e."{c}" - {m}) + {noise_sql("event", c, 2 * SD[c])})'
    first = f'({m} + w.amplitude * (e0."{c}" - {m}) + {noise_sql("event", c, 2 * SD[c], "w.start_row")})'
    a = ease_sql(R, f"least(30, {N})")
    moved = f'({now} + pre."{c}" - {first})'
    return f'case when {R} < least(30, {N}) then (1 - {a}) * b."{c}" + {a} * {moved} else {moved} end'


@register(
    "decoy_splice",
    with_ctes(
        BASE,
        EPISODES,
        KEPT_SQL,
        overlay_sql(
            {c: _spliced(c) for c in SIGNALS},
            f"""cross join means left join kept_d w on {IN_WINDOW} {PRE}
        left join episodes e on e.kind = w.kind and e.idx = {R}
        left join episodes e0 on e0.kind = w.kind and e0.idx = 0""",
        ),
        recursive=True,
    ),
)
def decoy_splice(spark, sf):
    rows = base(spark, sf)
    windows = kept(spark, sf)[1]
    out = O.splice(
        rows, windows, episodes(spark, sf), SIGNALS, D, amplitude=F.col("amplitude"),
        sd_by_col=SD,
    )
    return rounded(out, SIGNALS, *KEYS)


def _failed(c):
    a = ease_sql(R, f"least(30, {N})")
    moved = f'(e."{c}" + pre."{c}" - e0."{c}")'
    return f'case when {R} < least(30, {N}) then (1 - {a}) * b."{c}" + {a} * {moved} else {moved} end'


@register(
    "failure_episode",
    with_ctes(
        BASE,
        EPISODES,
        """fw as (select device_id, cast(floor(days * 100) as bigint) as start_row,
        cast(floor(days * 100) as bigint) + cast(floor(48 / sev) as bigint) as end_row, sev,
        'failure_' || list_extract(['bearing', 'impeller', 'radial'], s_nationkey % 3 + 1) as kind
        from (select *, 0.5::double + s_nationkey * 0.1::double as sev from devices
          where s_nationkey > 8))""",
        overlay_sql(
            {c: _failed(c) for c in SIGNALS},
            f"""left join fw w on {IN_WINDOW} {PRE}
        left join episodes e on e.kind = w.kind and e.idx = cast(floor({R} * w.sev) as bigint)
        left join episodes e0 on e0.kind = w.kind and e0.idx = 0""",
        ),
    ),
)
def failure_episode(spark, sf):
    sev = F.lit(0.5) + F.col("s_nationkey") * 0.1
    kinds = F.array(*[F.lit(f"failure_{k}") for k in K.PUMP_FAILURES])
    windows = failures(spark, sf).select(
        "device_id", "start_row", (F.col("start_row") + F.floor(F.lit(48.0) / sev)).alias("end_row"),
        sev.alias("sev"), F.element_at(kinds, (F.col("s_nationkey") % 3 + 1).cast("int")).alias("kind"),
    )
    out = O.splice(
        base(spark, sf), windows, episodes(spark, sf), SIGNALS, speed_up=F.col("sev"),
    )
    return rounded(out, SIGNALS, *KEYS)


def _moved(c, target):
    span = f"case when w.kind like '%ramp' then greatest(1.0, {N} * 0.6::double) else 5.0 end"
    a = ease_sql(f"least(1.0::double, {R} / ({span}))", "1.0")
    return f'pre."{c}" * (1 - {a}) + {target} * {a} + {noise_sql("event", c, SD[c])}'


@register(
    "target_overlay",
    with_ctes(
        BASE,
        LUT,
        SEGMENTS,
        KEPT_SQL,
        """targeted as (select k.*, a0 + (a1 - a0) * (v - p0) / (p1 - p0) as t_speed,
        b0 + (b1 - b0) * (v - p0) / (p1 - p0) as t_flow from (select *, 1 + amplitude * 30 as v
        from kept_d) k join segs on v >= p0 and v < p1)""",
        overlay_sql(
            {"speed": _moved("speed", "t_speed"), "flow": _moved("flow", "t_flow")},
            f"left join targeted w on {IN_WINDOW} {PRE}",
        ),
        recursive=True,
    ),
)
def target_overlay(spark, sf):
    windows = kept(spark, sf)[1].select(
        "device_id", "start_row", "end_row", "kind", F.lit("size").alias("axis"),
        (F.lit(1.0) + F.col("amplitude") * 30.0).alias("v"),
    )
    at = LU.interp(windows, lut(spark, sf), "v", ["price", "name_len"], prefix="at_")
    at = at.withColumnsRenamed({"at_price": "other_speed", "at_name_len": "other_flow"})
    sd = {"speed": 0.3, "flow": 0.005}
    return rounded(O.overlay_target(base(spark, sf), at, sd, D, (FREQ, 86400)), SIGNALS, *KEYS)


CURVE_WEAR = (
    f"(1 + 49 * (exp(3 * least({R} * 300.0::double / w.span_s, 1.0)) - 1) / (exp(3.0::double) - 1))"
)


def _worn(c, y0, y1):
    ss = f"(s.{y0} + (s.{y1} - s.{y0}) * ({CURVE_WEAR} - s.p0) / (s.p1 - s.p0))"
    a = f"case when {R} < 30 then {ease_sql(R, '30')} else 1.0 end"
    return f'b."{c}" * (1 - {a}) + {ss} * {a} + {noise_sql("failure", c, SD[c])}'


@register(
    "failure_curve",
    with_ctes(
        BASE,
        LUT,
        SEGMENTS,
        """fw as (select device_id, cast(floor(days * 100) as bigint) as start_row,
        cast(floor(days * 100) as bigint) + 60 as end_row, 60 * 300.0::double as span_s
        from devices where s_nationkey > 8)""",
        overlay_sql(
            {"speed": _worn("speed", "a0", "a1"), "flow": _worn("flow", "b0", "b1"), "wear": CURVE_WEAR},
            f"""left join fw w on {IN_WINDOW}
        left join segs s on {CURVE_WEAR} >= s.p0 and {CURVE_WEAR} < s.p1""",
        ),
    ),
)
def failure_curve(spark, sf):
    curve = LU.curve_array(
        lut(spark, sf).withColumnsRenamed({"price": "speed", "name_len": "flow"}), ["speed", "flow"]
    )
    windows = failures(spark, sf).select(
        "device_id", "start_row", "end_row", F.lit("size").alias("axis"),
        F.lit(1.0).alias("nominal"), F.lit(50.0).alias("failed"),
        F.lit(60 * 300.0).alias("span_s"), F.lit("wear").alias("wear_column"),
    ).join(curve, "axis").drop("axis")
    sd = {"speed": 0.3, "flow": 0.005}
    out = O.failure_curve(base(spark, sf), windows, sd, ["wear"], FREQ, D, bucket=(FREQ, 86400))
    return rounded(out, SIGNALS, *KEYS)


DOWN_WINDOWS = """dw as (select device_id, end_row - 1 as fail_row, end_row as start_row,
    end_row + 72 as end_row from fails)"""
FAILS_ONLY = FAIL_WINDOWS.split(",\n  all_windows")[0]


@register(
    "downtime_overlay",
    with_ctes(
        BASE,
        FAILS_ONLY,
        DOWN_WINDOWS,
        overlay_sql(
            {
                "speed": noise_sql("failure", "speed", 0.15),
                "flow": noise_sql("failure", "flow", 0.0025),
                "temp_K": f"""290 + (pre."temp_K" - 290) * exp(-{R} / 24.0::double)
          + {noise_sql('failure', 'temp_K', 0.2 * 0.3)}""",
                "wear": "pre.wear",
            },
            f"""left join dw w on {IN_WINDOW}
        left join base pre on pre.device_id = w.device_id and pre.row_i = w.fail_row""",
        ),
    ),
)
def downtime_overlay(spark, sf):
    fails = failures(spark, sf).select("device_id", (F.col("end_row") - 1).alias("fail_row"))
    out = O.overlay_downtime(
        base(spark, sf), fails, STOPPED, COOLED, ["wear"], 72, FREQ, D, bucket=(FREQ, 86400)
    )
    return rounded(out, SIGNALS, *KEYS)


UP = f"case when {R} < 48 then {ease_sql(R, 'least(48, ' + N + ')')} else 1.0 end"


@register(
    "restart_overlay",
    with_ctes(
        BASE,
        FAILS_ONLY,
        f"""uw as (select device_id, f.end_row + 72 as start_row,
        cast(floor(days * 86400 / {FREQ}.0) as bigint) + 1 as end_row from fails f
        join devices using (device_id))""",
        overlay_sql(
            {
                "speed": f"b.speed * {UP}",
                "flow": f"b.flow * {UP}",
                "temp_K": f'290 + (b."temp_K" - 290) * {UP}',
                "wear": "m_wear",
            },
            f"cross join means left join uw w on {IN_WINDOW}",
        ),
    ),
)
def restart_overlay(spark, sf):
    last = S.row_count(F.col("days"), FREQ)
    restarts = failures(spark, sf).select(
        "device_id", (F.col("end_row") + 72).alias("start_row"), last.alias("end_row")
    ).where("end_row > start_row")
    means = S.template_mean(profile(spark, sf), ["wear"], "start_")
    out = O.overlay_restart(
        base(spark, sf), S.with_one_row(restarts, means), ["speed", "flow"], ["temp_K"], ["wear"],
        48, bucket=(FREQ, 86400),
    )
    return rounded(out, SIGNALS, *KEYS)
