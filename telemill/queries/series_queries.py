"""Analysis of labelled series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analyse as A
from ..operators import labels as L
from ..operators.chunks import with_row_index
from .base import TELE, Registry, r6, table, tele, with_ctes

register = Registry()


@register(
    "label_summary",
    with_ctes(
        TELE,
        """select device_id, count(*) as rows,
      count(*) filter (label = 'NORMAL') as "NORMAL",
      count(*) filter (label = 'PRE_FAILURE') as "PRE_FAILURE",
      count(*) filter (label = 'FAILURE') as "FAILURE" from tele group by 1""",
    ),
)
def label_summary(spark, sf):
    return A.label_summary(tele(spark, sf))


@register("value_counts", with_ctes(TELE, "select event_type, count(*) as n from tele group by 1"))
def value_counts(spark, sf):
    return A.value_counts(tele(spark, sf), "event_type")


DECOYED = """decoyed as (select *, case when event_type in ('click', 'view')
  then 'decoy_' || event_type else 'normal' end as kind from tele)"""


def _decoyed(df):
    busy = F.col("event_type").isin("click", "view")
    return df.withColumn(
        "kind", F.when(busy, F.concat(F.lit("decoy_"), "event_type")).otherwise("normal")
    )


@register(
    "series_summary",
    with_ctes(
        TELE,
        DECOYED,
        """select device_id, count(*) as rows,
      printf('%.0f', count(*) * 3600 / 86400.0) as days,
      count(*) filter (label = 'NORMAL') as "NORMAL",
      count(*) filter (label = 'PRE_FAILURE') as "PRE_FAILURE",
      count(*) filter (label = 'FAILURE') as "FAILURE",
      count(*) filter (starts_with(kind, 'decoy_')) as decoy_rows from decoyed group by 1""",
    ),
)
def series_summary(spark, sf):
    return A.series_summary(_decoyed(tele(spark, sf)), 3600, event="kind")


def spans_sql(col: str, source: str = "tele") -> str:
    return f"""marked as (select *, case when row_i = 0 or {col} is distinct from
      lag({col}) over (partition by device_id order by row_i) then 1 else 0 end as flag,
      lead(ts_us) over (partition by device_id order by row_i) as next_ts from {source}),
    runs as (select *, sum(flag) over (partition by device_id order by row_i) as run from marked)"""


SPANS = """select device_id, min(row_i) as start_row, min(ts_us) as start,
  max(coalesce(next_ts, ts_us)) as "end", min({col}) as {col}, count(*) as rows
  from runs group by device_id, run"""


@register("event_spans", with_ctes(TELE, spans_sql("event_type"), SPANS.format(col="event_type")))
def event_spans(spark, sf):
    return A.event_spans(tele(spark, sf), "event_type", "ts_us")


@register(
    "label_spans",
    with_ctes(
        TELE,
        spans_sql("label"),
        f"select * from ({SPANS.format(col='label')}) where label <> 'NORMAL'",
    ),
)
def label_spans(spark, sf):
    return A.label_spans(tele(spark, sf), time="ts_us")


@register(
    "row_spans",
    with_ctes(
        TELE,
        """select * from (select device_id, row_i, ts_us as start,
      lead(ts_us) over (partition by device_id order by row_i) as "end", label from tele)
      where "end" is not null""",
    ),
)
def row_spans(spark, sf):
    return A.row_spans(tele(spark, sf), time="ts_us")


@register(
    "downsample",
    with_ctes(TELE, "select device_id, row_i, ts_us, x from tele where row_i % 50 = 0"),
)
def downsample(spark, sf):
    return A.downsample(tele(spark, sf), 50).select("device_id", "row_i", "ts_us", "x")


@register(
    "failure_zoom",
    with_ctes(
        TELE,
        """select t.device_id, t.row_i, t.x, t.label from tele t join
      (select device_id, min(row_i) as f from tele where label = 'FAILURE' group by 1) z
      using (device_id) where t.row_i >= z.f - 12 and t.row_i < z.f + 12""",
    ),
)
def failure_zoom(spark, sf):
    return A.zoom(tele(spark, sf), 12).select("device_id", "row_i", "x", "label")


BUSY = """counted as (select *, sum((kind <> 'normal')::int) over (partition by device_id
    order by row_i rows between 29 preceding and current row) as busy from decoyed),
  best as (select device_id, count(*) as n,
    {fail} as f,
    max(busy) as top from counted group by 1),
  centred as (select b.device_id, b.n, coalesce(b.f, case when b.top > 0 then
      (select min(c.row_i) from counted c where c.device_id = b.device_id and c.busy = b.top)
    end, b.n // 2) as centre from best b)
  select device_id, centre,
    greatest(least(n, greatest(centre - 15, 0) + 30) - 30, 0) as start_row,
    least(n, greatest(centre - 15, 0) + 30) as end_row from centred"""


@register(
    "busiest_window",
    with_ctes(TELE, DECOYED + ", " + BUSY.format(fail="cast(null as bigint)")),
)
def busiest_window(spark, sf):
    return A.busiest_window(_decoyed(tele(spark, sf)), 30, "kind", label=None)


@register(
    "failure_centred_window",
    with_ctes(
        TELE, DECOYED + ", " + BUSY.format(fail="min(row_i) filter (label = 'FAILURE')")
    ),
)
def failure_centred_window(spark, sf):
    return A.busiest_window(_decoyed(tele(spark, sf)), 30, "kind")


LONG_BUSY = (
    BUSY.replace("29 preceding", "7999 preceding").replace("centre - 15", "centre - 4000").replace("+ 30", "+ 8000").replace("- 30", "- 8000")
)


@register(
    "long_busiest_window",
    with_ctes(
        """decoyed as (select l_returnflag as device_id,
      row_number() over (partition by l_returnflag order by l_shipdate, l_orderkey, l_linenumber) - 1 as row_i,
      case when l_quantity >= 40 then 'decoy_load' else 'normal' end as kind from lineitem)""",
        LONG_BUSY.format(fail="cast(null as bigint)"),
    ),
)
def long_busiest_window(spark, sf):
    """Order lines by return flag: a window of 8,000 rows, half the series or more, in chunks of 1,000."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("device_id"), "l_shipdate", "l_orderkey", "l_linenumber",
        F.when(F.col("l_quantity") >= 40, "decoy_load").otherwise("normal").alias("kind"),
    )
    rows = with_row_index(lines, ["device_id"], ["l_shipdate", "l_orderkey", "l_linenumber"])
    return A.busiest_window(rows, 8_000, "kind", label=None, chunk_rows=1_000)


@register(
    "group_compare",
    """select r_name as series, cast(l_orderkey as bigint) as t, l_quantity as x,
      l_extendedprice as y from lineitem join supplier on l_suppkey = s_suppkey
      join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
      where r_name in ('ASIA', 'EUROPE')""",
)
def group_compare(spark, sf):
    sup = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nat = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    reg = table(spark, sf, "region")
    dim = (
        sup.join(nat, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(reg, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("scenario_id"), F.col("r_name").alias("scenario"))
    )
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("scenario_id"), "l_orderkey", "l_quantity", "l_extendedprice"
    )
    return A.compare(rows, dim, ["ASIA", "EUROPE"], "l_quantity", "l_extendedprice", "l_orderkey")


RESIDUAL = """line as (select regr_slope(l_extendedprice, l_quantity) as b,
    regr_intercept(l_extendedprice, l_quantity) as a from lineitem where l_returnflag = 'N'),
  res as (select l.*, l_extendedprice - (a + b * l_quantity) as residual from lineitem l, line)"""


@register(
    "baseline_residual",
    with_ctes(
        RESIDUAL,
        """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
      round(residual, 3) + 0.0 as residual from res""",
    ),
)
def baseline_residual(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag",
    )
    out = A.residual(rows, "l_quantity", "l_extendedprice", F.col("l_returnflag") == "N")
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6("residual", 3).alias("residual")
    )


@register(
    "residual_summary",
    with_ctes(
        RESIDUAL,
        """select l_suppkey, count(*) as rows, round(avg(residual), 3) + 0.0 as mean_residual,
      round(stddev_samp(residual), 3) + 0.0 as sd_residual from res group by 1""",
    ),
)
def residual_summary(spark, sf):
    out = A.residual_summary(
        table(spark, sf, "lineitem"),
        "l_quantity",
        "l_extendedprice",
        F.col("l_returnflag") == "N",
        "l_suppkey",
    )
    return out.withColumns({c: r6(c, 3) for c in ("mean_residual", "sd_residual")})


@register("distinct_events", with_ctes(TELE, "select distinct event_type from tele"))
def distinct_events(spark, sf):
    return A.distinct_events(tele(spark, sf))


@register(
    "label_variety",
    with_ctes(
        TELE,
        """select device_id, count(distinct label) as n_labels,
      count(distinct label) > 1 as mixed from tele group by 1""",
    ),
)
def label_variety(spark, sf):
    return A.label_variety(tele(spark, sf))


@register(
    "split_by_label",
    with_ctes(
        TELE,
        """select device_id, label, ts_us, 'x' as signal, x as value from tele union all
      select device_id, label, ts_us, 'twice_x', x * 2 from tele""",
    ),
)
def split_by_label(spark, sf):
    df = tele(spark, sf).withColumn("twice_x", F.col("x") * 2)
    return A.split_by_label(df, ["x", "twice_x"], time="ts_us")


# -- labels --------------------------------------------------------------


CROSS = """fails as (select device_id, coalesce(min(row_i) filter (x < 0.5), max(row_i))
  as fail_row from tele group by 1)"""


def _fails(spark, sf):
    return L.first_crossing(tele(spark, sf), "x", F.lit(0.5))


@register("first_crossing", with_ctes(TELE, CROSS, "select * from fails"))
def first_crossing(spark, sf):
    return _fails(spark, sf)


@register(
    "label_tail",
    with_ctes(
        TELE,
        """lasts as (select device_id, max(row_i) as f from tele group by 1)
      select t.device_id, t.row_i,
        case when t.device_id % 3 = 0 then 'NORMAL' when row_i >= f then 'FAILURE'
          when row_i >= f - 12 then 'PRE_FAILURE' else 'NORMAL' end as label,
        case when t.device_id % 3 = 0 or row_i < f - 12 then -1.0
          else (f - row_i) * 300.0 end as time_to_failure_s
      from tele t join lasts using (device_id)""",
    ),
)
def label_tail(spark, sf):
    df = tele(spark, sf).select("device_id", "row_i", (F.col("device_id") % 3 != 0).alias("faulty"))
    return L.label_tail(df, "faulty", 300).select(
        "device_id", "row_i", "label", "time_to_failure_s"
    )


@register(
    "label_from_row",
    with_ctes(
        TELE,
        CROSS,
        """select t.device_id, t.row_i,
        case when row_i >= f.fail_row then 'FAILURE'
          when row_i >= f.fail_row - 12 then 'PRE_FAILURE' else 'NORMAL' end as label,
        case when row_i < f.fail_row - 12 then -1.0
          else greatest(f.fail_row - row_i, 0) * 300.0 end as time_to_failure_s
      from tele t join fails f using (device_id)""",
    ),
)
def label_from_row(spark, sf):
    df = tele(spark, sf).select("device_id", "row_i")
    return L.label_from(df, _fails(spark, sf), 300)


@register(
    "label_episode",
    with_ctes(
        TELE,
        CROSS,
        """select t.device_id, t.row_i,
        case when row_i = f.fail_row then 'FAILURE'
          when row_i >= greatest(f.fail_row - 13, f.fail_row // 2) and row_i < f.fail_row
            then 'PRE_FAILURE' else 'NORMAL' end as label,
        case when row_i >= greatest(f.fail_row - 13, f.fail_row // 2) and row_i <= f.fail_row
          then (f.fail_row - row_i) * 300.0 else -1.0 end as time_to_failure_s
      from tele t join fails f using (device_id)""",
    ),
)
def label_episode(spark, sf):
    episodes = _fails(spark, sf).withColumn("start_row", F.expr("fail_row div 2"))
    df = tele(spark, sf).select("device_id", "row_i")
    return L.label_episode(df, episodes, 300, inclusive_extra=1)
