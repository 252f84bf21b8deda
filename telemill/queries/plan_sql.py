"""SQL twins of the whole builds, put together from the twins of their steps."""

from __future__ import annotations

import re

from .. import constants as K
from .base import sql_n, sql_u
from .draw_queries import poisson_sql

FREQ = 300
DAY_ROWS = 86400 // FREQ
BASE_SEED = K.FLEET_SEED
SEED = f"' || ({BASE_SEED} + cast(right(device_id, 6) as bigint)) || '"
WHO = f"'{SEED}|' || device_id"
EVENT = f"{WHO} || '|' || event_day || '|' || event_in_day"


def seed_of(alias: str) -> str:
    return f"'' || ({BASE_SEED} + cast(right({alias}.device_id, 6) as bigint)) || '|' || {alias}.device_id"


def row_n(stream: str, alias: str = "b", row: str = "row_i") -> str:
    return sql_n(f"{seed_of(alias)} || '|' || {alias}.{row}", stream)


def ease(r: str, n: str) -> str:
    return f"(0.5 * (1 - cos(3.141592653589793 * ({r}) / ({n}))))"


def manifest(prefix, types, decoys, v_nom, days, pump) -> str:
    """CTE ``man``: unrounded manifest of the suppliers."""
    k = f"'{BASE_SEED}|' || s_suppkey"
    opts = ", ".join(f"('{o}')" for o in decoys)
    lo, hi = 0.3 * days, 0.95 * days
    quota = " ".join(f"when r < {i + 1} * floor(n * 0.2) then '{t}'" for i, t in enumerate(types))
    offset = f"27859.62 * {sql_n(k, 'p_offset')}" if pump else "0.0"
    return f"""ranked as (select s_suppkey, row_number() over (order by
    md5('{BASE_SEED}|' || s_suppkey || '|quota'), s_suppkey) - 1 as r, count(*) over () as n from supplier),
  opts(o) as (values {opts}),
  hashed as (select s_suppkey, o, md5('{BASE_SEED}|' || s_suppkey || '|decoy_type|' || o) as h,
    floor(1.0 + {sql_u(k, 'decoy_n')} * {len(decoys)}.0) as k from supplier, opts),
  placed as (select *, row_number() over (partition by s_suppkey order by h) as p from hashed),
  chosen as (select s_suppkey, list(o order by h) as types from placed where p <= k group by 1),
  man as materialized (select printf('{prefix}_%06d', s_suppkey) as device_id, {days}::double as days,
    cast(floor({days} * 86400 / {FREQ}.0) as bigint) + 1 as n, types,
    case {quota} end as ftype, {lo}::double + {sql_u(k, 'start')} * ({hi}::double - {lo}::double) as fday,
    least(greatest(exp(0.4 * {sql_n(k, 'severity')}), 0.3), 3.0) as sev,
    2.0 + {sql_u(k, 'ambient')} * 10.0 as amb, 0.1 + {sql_u(k, 'duty')} * (0.8::double - 0.1::double) as dut,
    least(greatest(-2.0 * ln(1.0 - {sql_u(k, 'decoy_freq')}), 0.0), 8.0) as dfreq,
    0.5 + {sql_u(k, 'noise')} * 1.5 as ns, {v_nom * 0.02} * {sql_n(k, 'v_offset')} as vo,
    {offset} as po from ranked join chosen using (s_suppkey))"""


def rows_and_walk(cols, sd) -> str:
    """CTEs ``spine`` and ``walk``: rows with the random walk of each signal."""
    day_key = f"{WHO} || '|' || day"
    totals = ", ".join(f"{sd} * sqrt(nd) * {sql_n(day_key, 'drift_day_' + c)} as t_{c}" for c in cols)
    carries = ", ".join(
        f"""coalesce(sum(t_{c}) over (partition by device_id order by day
      rows between unbounded preceding and 1 preceding), 0) as c_{c}"""
        for c in cols
    )
    row_key = f"{WHO} || '|' || row_i"
    steps = ", ".join(f"{sd} * {sql_n(row_key, 'drift_' + c)} as z_{c}" for c in cols)
    walks = ", ".join(
        f"""c_{c} + sum(z_{c}) over so_far - ((row_i - d_from + 1)::double / nd)
      * (sum(z_{c}) over whole_day - t_{c}) as w_{c}"""
        for c in cols
    )
    return f"""spine as (select *, row_i * {FREQ} // 86400 as day, row_i * {FREQ} as time_s,
    row_i * {FREQ} / 3600.0::double as time_h from (select *, unnest(range(0, n)) as row_i from man)),
  day_n as (select device_id, day, count(*) as nd, min(row_i) as d_from from spine group by 1, 2),
  day_t as (select *, {totals} from day_n),
  day_c as (select *, {carries} from day_t),
  steps as (select s.*, d.* exclude (device_id, day), {steps.replace('device_id', 's.device_id')}
    from spine s join day_c d on s.device_id = d.device_id and s.day = d.day),
  walk as (select *, {walks} from steps
    window so_far as (partition by device_id, day order by row_i),
      whole_day as (partition by device_id, day))"""


def windows(decoy_hours, amplitude, per_day, lengths: bool) -> str:
    """CTEs ``kept``: accepted maintenance and decoy windows, with ``kind`` and ``amplitude``."""
    lo, hi = amplitude
    hours = f"(2.0 + {sql_u(EVENT, 'maintenance_hours')} * 4.0)"
    a, b = decoy_hours
    dhours = f"({a} + {sql_u(EVENT, 'decoy_hours')} * ({b} - {a}))"
    name = f"'decoy_' || list_extract(types, cast(floor({sql_u(EVENT, 'decoy_type')} * len(types)) as bigint) + 1)"
    trimmed = "least(proposed_end, start_row + len)" if lengths else "proposed_end"
    joined = "join lens l on l.kind = p.kind" if lengths else ""
    poisson = poisson_sql("man", str(per_day), "days", SEED, "maintenance", "m")
    poisson += ", " + poisson_sql("man", "dfreq", "days", SEED, "decoy", "d")

    def walked(source, out):
        return f"""{out}_o as (select *, row_number() over (partition by device_id
      order by start_row, event_day, event_in_day) as rn from {source}),
    {out}_r as (select *, end_row as reached, true as free from {out}_o where rn = 1 union all
      select o.*, case when o.start_row >= r.reached then o.end_row else r.reached end,
        o.start_row >= r.reached from {out}_r r join {out}_o o
        on o.device_id = r.device_id and o.rn = r.rn + 1),
    {out} as materialized (select * exclude (rn, reached, free) from {out}_r where free)"""

    return f"""{poisson},
  m_p as (select *, cast(floor(time_s / {FREQ}) as bigint) as start_row,
    cast(floor(time_s / {FREQ}) as bigint) + cast(floor({hours} * 3600.0 / {FREQ}) as bigint) as end_row,
    'maintenance' as kind, 0.0::double as amplitude from m_events join man using (device_id)),
  m_all as (select device_id, event_day, event_in_day, start_row, end_row, kind, amplitude from m_p
    where end_row < n and end_row > start_row),
  {walked('m_all', 'kept_m')},
  d_p as (select *, cast(floor(time_s / {FREQ}) as bigint) as start_row,
    cast(floor(time_s / {FREQ}) as bigint) + cast(floor({dhours} * 3600.0 / {FREQ}) as bigint) as proposed_end,
    {name} as kind, {lo} + {sql_u(EVENT, 'decoy_amplitude')} * ({hi}::double - {lo}) as amplitude
    from d_events join man using (device_id)),
  d_all as (select p.device_id, event_day, event_in_day, start_row, {trimmed} as end_row, p.kind,
    amplitude from d_p p {joined} where proposed_end < n and proposed_end > start_row
    and not exists (select 1 from kept_m m where m.device_id = p.device_id
      and p.start_row < m.end_row and m.start_row < p.proposed_end)),
  {walked('d_all', 'kept_d')},
  kept as materialized (select * from kept_m union all select * from kept_d)"""


R, N = "(b.row_i - w.start_row)", "(w.end_row - w.start_row)"
RAMP = f"least(30, {N} // 4)"
COOL = 7200.0 / FREQ


def stopped(c, sd):
    return f"""case when {R} < {RAMP} then pre."{c}" * (1 - {ease(R, RAMP)})
      when {R} >= {N} - {RAMP} then post."{c}" * {ease(f'{R} - ({N} - {RAMP})', RAMP)}
      else {sd * 0.3} * {row_n('event_' + c)} end"""


def cooled(c, sd):
    return f"""case when {R} < {RAMP} then 290 + (pre."{c}" - 290) * (1 - {ease(R, RAMP)})
      when {R} >= {N} - {RAMP} then 290 + (post."{c}" - 290) * {ease(f'{R} - ({N} - {RAMP})', RAMP)}
      else 290 + (pre."{c}" - 290) * (1 - {ease(f'{RAMP} - 1', RAMP)}) * exp(-({R} - {RAMP}) / {COOL}::double)
        + {sd * 0.3} * {row_n('event_' + c)} end"""


IN_WINDOW = "b.device_id = w.device_id and b.row_i >= w.start_row and b.row_i < w.end_row"
ANCHORS = """left join base pre on pre.device_id = w.device_id and pre.row_i = w.start_row
    left join base post on post.device_id = w.device_id and post.row_i = w.end_row"""
STATES = "label, time_to_failure_s, event_type"


def final(signals, extra="") -> str:
    cols = ", ".join(f'round("{c}", 6) + 0.0 as "{c}"' for c in signals)
    return f"""select device_id, row_i, {cols}, time_s, time_h, {STATES}{extra} from done"""


def labelled(extra: int, failure_kind: str) -> str:
    """Label columns from ``f`` (failing devices) and ``p`` (phase of the row)."""
    first = f"greatest(fail_row - 12 - {extra}, fail_start, 0)"
    return f"""case when phase = 'failure' then case when row_i = fail_row then 'FAILURE'
        when row_i >= {first} then 'PRE_FAILURE' else 'NORMAL' end
      when phase = 'post_failure' then 'FAILURE' else 'NORMAL' end as label,
    case when phase = 'failure' and row_i >= {first} then (fail_row - row_i) * {FREQ}.0::double
      else -1.0::double end as time_to_failure_s,
    case when phase = 'failure' then {failure_kind}
      when phase in ('post_failure', 'startup') then phase else b.ev end as event_type"""


PHASED = """phased as (select b.*, f.* exclude (device_id), case when f.fail_start is null or b.row_i < f.fail_start then null
      when b.row_i <= f.fail_row then 'failure' when b.row_i <= f.fail_row + 72 then 'post_failure'
      when b.row_i <= f.fail_row + 120 then 'startup' else 'repaired' end as phase
    from l1 b left join fails f on f.device_id = b.device_id)"""


def pump_positions(signals: str) -> str:
    """CTEs ``positions`` (profile by position), ``means``, ``episodes`` and ``lens``."""
    cols = ", ".join(f'avg("{c}") as "{c}"' for c in K.PUMP_SIGNALS)
    return f"""positions as materialized (select l_orderkey % 60 as i, {signals} from lineitem group by 1),
  means as materialized (select {cols} from positions where i >= 48),
  episodes as materialized (select case when l_linestatus = 'O' then 'decoy_' || list_extract(
      {K.PUMP_DECOYS}, (l_linenumber - 1) % 4 + 1) else 'failure_' || list_extract(
      {K.PUMP_FAILURES}, (l_linenumber - 1) % 3 + 1) end as kind,
    l_orderkey % case when l_linestatus = 'O' then 49 else 73 end as idx, {signals}
    from lineitem group by 1, 2),
  lens as (select kind, max(idx) + 1 as len from episodes group by 1)"""


def pump_series(
    text: dict[str, str], days: float, man: str | None = None, per_day: float = 0.5, extra: str = ""
) -> str:
    cols = list(text)
    signals = ", ".join(f'{t} as "{c}"' for c, t in text.items())
    temps, speeds, flows, states = K.PUMP_TEMPS, K.PUMP_SPEEDS, K.PUMP_FLOWS, K.PUMP_STATES
    sd = K.PUMP_NOISE_SD
    warm = """(-amb * cos(6.283185307179586 * (time_h - 4) / 24)
      - amb * 0.5 * cos(6.283185307179586 * (time_h / 24) / 365))"""
    hour = "(time_h - 24 * floor(time_h / 24))"
    duty = f"""((1 - case when {hour} >= 6 and {hour} < 18 then 0.0 else 0.6 * dut end
      * (1 - least(greatest(({hour} - 5) / 2, 0), 1) * least(greatest((19 - {hour}) / 2, 0), 1)))
      * case when floor(time_h / 24) % 7 >= 5 then 1 - 0.3 * dut else 1.0 end)"""

    def based(c):
        x = f'p."{c}"'
        if sd[c]:
            x = f"({x} + {row_n('noise_' + c)} * ({sd[c]} * ns))"
        if c in temps:
            x = f'({x} + "w_{c}" + {warm})'
        if c in speeds + flows:
            x = f'(m."{c}" + ({x} - m."{c}") * {duty})'
        if c in speeds:
            x = f"({x} + vo * 0.8)"
        if c in flows:
            x = f"({x} * (1 + po / 928654.0::double))"
        return f'{x} as "{c}"'

    def event(c):
        blend = f"least(30, {N})"
        moved = f"""(pre."{c}" + w.amplitude * (e."{c}" - e0."{c}") + {2 * sd[c]}
          * ({row_n('event_' + c)} - {row_n('event_' + c, 'w', 'start_row')}))"""
        a = f"case when {R} < {blend} then {ease(R, blend)} else 1.0 end"
        stop = stopped(c, sd[c]) if c in speeds + flows else cooled(c, sd[c]) if c in temps else f'b."{c}"'
        return f"""case when w.kind is null then b."{c}" when w.kind = 'maintenance' then {stop}
          else (1 - ({a})) * b."{c}" + ({a}) * {moved} end as "{c}" """

    q = "(b.row_i - fail_start)"
    fb = "least(30, fail_row + 1 - fail_start)"
    fa = f"case when {q} < {fb} then {ease(q, fb)} else 1.0 end"
    broken = ", ".join(
        f"""(1 - ({fa})) * b."{c}" + ({fa}) * (e."{c}" + pre."{c}" - e0."{c}") as "x_{c}" """
        for c in cols
    )
    d = "(b.row_i - b.fail_row - 1)"
    u = "(b.row_i - b.fail_row - 73)"
    up = ease(u, "least(48, b.n - b.fail_row - 73)")

    def finished(c):
        noise = row_n("failure_" + c)
        if c in states:
            post, start, rest = f'h."x_{c}"', f'm."{c}"', f'm."{c}"'
        elif c in temps:
            post = f"""290 + (h."x_{c}" - 290) * exp(-{d} / {COOL}::double) + {0.3 * sd[c]} * {noise}"""
            start, rest = f'290 + (b."{c}" - 290) * {up}', f'b."{c}"'
        else:
            post, start, rest = f"{0.5 * sd[c]} * {noise}", f'b."{c}" * {up}', f'b."{c}"'
        return f"""case when phase = 'failure' then x."x_{c}" when phase = 'post_failure' then {post}
          when phase = 'startup' then {start} when phase = 'repaired' then {rest} else b."{c}" end as "{c}" """

    return "with recursive " + ", ".join(
        [
            man or manifest("device", K.PUMP_FAILURES, K.PUMP_DECOYS, K.PUMP_V_NOM, days, True),
            pump_positions(signals),
            rows_and_walk(temps, K.PUMP_DRIFT_SD),
            f"""base as materialized (select b.device_id, b.row_i, b.n, b.time_s, b.time_h,
    {', '.join(based(c) for c in cols)} from walk b join positions p
    on p.i = case when b.row_i < 48 then b.row_i else 48 + (b.row_i - 48) % 12 end, means m)""",
            windows((1.0, 6.0), (0.4, 1.6), per_day, True),
            f"""l1 as materialized (select b.device_id, b.row_i, b.n, b.time_s, b.time_h,
    coalesce(w.kind, 'normal') as ev, {', '.join(event(c) for c in cols)}
    from base b left join kept w on {IN_WINDOW} {ANCHORS}
    left join episodes e on e.kind = w.kind and e.idx = {R}
    left join episodes e0 on e0.kind = w.kind and e0.idx = 0)""",
            f"""fails as (select device_id, fkind, sev, fail_start,
    least(fail_start + cast(floor(len / sev) as bigint), n) - 1 as fail_row from
    (select *, 'failure_' || ftype as fkind, cast(floor(fday * 86400.0 / {FREQ}) as bigint) as fail_start
      from man where ftype is not null) join lens on kind = fkind)""",
            PHASED,
            f"""broken as materialized (select b.device_id, b.row_i, {broken} from phased b
    join l1 pre on pre.device_id = b.device_id and pre.row_i = fail_start
    left join episodes e on e.kind = fkind and e.idx = cast(floor({q} * sev) as bigint)
    left join episodes e0 on e0.kind = fkind and e0.idx = 0 where phase = 'failure')""",
            f"""done as (select b.device_id, b.row_i, b.time_s, b.time_h, {', '.join(finished(c) for c in cols)},
    {labelled(0, 'fkind').replace('row_i', 'b.row_i')}
    from phased b left join broken x on x.device_id = b.device_id and x.row_i = b.row_i
    left join broken h on h.device_id = b.device_id and h.row_i = b.fail_row, means m)""",
        ]
    ) + " " + final(cols, extra + ", round(greatest(flow_in_m3s - flow_out_m3s, 0.0), 6) + 0.0 as flow_gap_m3s")


def motor_inputs(text: dict[str, str], axes: dict[str, tuple[float, float]]) -> str:
    """CTEs ``lut``, ``segs``, ``ends`` and ``level``."""
    cols = ", ".join(f'avg({t}) as "{c}"' for c, t in text.items())
    points = " union all ".join(
        f"""select '{axis}' as axis, {min(a)!r}::double + i * {(max(a) - min(a)) / (K.LUT_POINTS - 1)!r}::double
        as param, {', '.join(f'"{c}"' for c in text)} from (select floor(({a[0]!r}::double
        + (p_size - 1) / 49.0::double * {a[1] - a[0]!r}::double - {min(a)!r}::double)
        / {(max(a) - min(a)) / (K.LUT_POINTS - 1)!r}::double + 0.5) as i, {cols} from part group by 1)
        where i between 0 and {K.LUT_POINTS - 1}"""
        for axis, a in axes.items()
    )
    ends = ", ".join(
        f'"{c}" as "y0_{c}", lead("{c}") over by_axis as "y1_{c}"' for c in text
    )
    return f"""lut as ({points}),
  ends as (select axis, min(param) as p_min, max(param) as p_max from lut group by 1),
  segs as materialized (select * from (select axis, param as p0, lead(param) over by_axis as p1, {ends},
    p_min, p_max from lut join ends using (axis) window by_axis as (partition by axis order by param))
    where p1 is not null),
  level as materialized (select {cols} from part where p_size = 1)"""


def seg_join(alias: str, axis: str, x: str) -> str:
    """Join of the segment that holds ``x``, held at the ends."""
    held = f"least(greatest({x}, {alias}.p_min), {alias}.p_max)"
    return f"""segs {alias} on {alias}.axis = {axis} and {held} >= {alias}.p0
      and ({held} < {alias}.p1 or ({alias}.p1 = {alias}.p_max and {held} = {alias}.p_max))"""


def seg_value(alias: str, c: str, x: str, held: bool = True) -> str:
    at = f"least(greatest({x}, {alias}.p_min), {alias}.p_max)" if held else x
    return f"""({alias}."y0_{c}" + ({alias}."y1_{c}" - {alias}."y0_{c}")
      * (({at}) - {alias}.p0) / ({alias}.p1 - {alias}.p0))"""


def by_value(column: str, table: dict[str, object]) -> str:
    return f"case {column} " + " ".join(
        f"when '{k}' then {v!r}" + ("::double" if isinstance(v, float) else "")
        for k, v in table.items()
    ) + " end"


def worn(t: str, nominal: str, failed: str, span: str) -> str:
    return f"""({nominal} + ({failed} - {nominal}) * (exp(3 * least(({t}) / ({span}), 1.0)) - 1)
      / (exp(3.0::double) - 1))"""


def motor_series(text, axes, days: float, man=None, per_day=0.5, extra="") -> str:
    resp, params, sd = K.MOTOR_RESPONSES, K.MOTOR_PARAMS, K.MOTOR_NOISE_SD
    speed, current = resp[:2]
    coupled = """(amb * 0.01 * sin(6.283185307179586 * (time_h - 14) / 24)
      + amb * 0.005 * sin(6.283185307179586 * time_h / 8760))"""
    hour = "(time_h - 24 * floor(time_h / 24))"
    duty = f"""(case when {hour} >= 6 and {hour} < 18 then 1.0 else 1 - 0.4 * dut end
      * case when floor(time_h / 24) % 7 >= 5 then 1 - 0.3 * dut else 1.0 end)"""

    def raw(c):
        x = f'v."{c}" + {row_n("noise_" + c)} * ({sd[c]} * ns) + "w_{c}"'
        if c in (speed, current):
            x += f' + "shift_{c}"'
        if c == speed:
            x = f"({x}) - 10 * {coupled}"
        return f'{x} as "{c}"'

    nominal = {v[0]: v[1] for v in K.MOTOR_WEAR.values()}
    fixed = ", ".join(
        f'{nominal[c]!r}::double{" + " + coupled if c == "resistance_ohm" else ""} as "{c}"' for c in params
    )
    kinds = {f"decoy_{k}": a for k, a in K.MOTOR_DECOY_AXIS.items()}
    low = by_value("axis", {a: v[0] for a, v in K.MOTOR_INPUTS.items()})
    high = by_value("axis", {a: v[1] for a, v in K.MOTOR_INPUTS.items()})

    def event(c):
        span = f"case when w.kind like '%ramp' then greatest(1.0, {N} * 0.6::double) else 5.0 end"
        a = ease(f"least(1.0::double, {R} / ({span}))", "1.0")
        return f"""case when w.kind is null then b."{c}" when w.kind = 'maintenance' then {stopped(c, sd[c])}
          else pre."{c}" * (1 - {a}) + w."t_{c}" * {a} + {sd[c]} * {row_n('event_' + c)} end as "{c}" """

    wear_at = worn(f"r * {FREQ}.0::double", "p_nom", "p_fail", "span_s")
    q = "(b.row_i - b.fail_start)"
    wear = worn(f"{q} * {FREQ}.0::double", "b.p_nom", "b.p_fail", "b.span_s")
    last = worn(f"(b.fail_row - b.fail_start) * {FREQ}.0::double", "b.p_nom", "b.p_fail", "b.span_s")
    active = f"phase = 'failure' and {q} < b.wear_rows"
    u = "(b.row_i - b.fail_row - 73)"
    up = ease(u, "least(48, b.n - b.fail_row - 73)")
    fa = f"case when {q} < 30 then {ease(q, '30')} else 1.0 end"

    def finished(c):
        if c in params:
            mine = f"b.wear_column = '{c}'"
            return f"""case when {active} and {mine} then {wear}
              when phase = 'post_failure' and {mine} then {last}
              when phase in ('startup', 'repaired') then z."{c}" else b."{c}" end as "{c}" """
        noise = f"{sd[c]} * {row_n('failure_' + c)}"
        return f"""case when {active} then (1 - ({fa})) * b."{c}" + ({fa}) * {seg_value('s', c, wear)} + {noise}
          when phase = 'post_failure' then 0.3 * {noise}
          when phase = 'startup' then {up} * (z."{c}" + {noise}) else b."{c}" end as "{c}" """

    wear_of = {k: K.MOTOR_WEAR[k] for k in K.MOTOR_WEAR}
    return "with recursive " + ", ".join(
        [
            man or manifest("motor", K.MOTOR_FAILURES, K.MOTOR_DECOYS, K.MOTOR_V_NOM, days, False),
            motor_inputs(text, axes),
            rows_and_walk(resp, K.MOTOR_DRIFT_SD_LONG),
            f"""shift as (select device_id, {', '.join(
                f'{seg_value("a", c, "23.0 + vo", False)} - {seg_value("z", c, "23.0::double", False)} as "shift_{c}"'
                for c in (speed, current))} from man join {seg_join('a', "'voltage'", '23.0 + vo')}
    join {seg_join('z', "'voltage'", '23.0::double')}),
  raw as materialized (select b.device_id, b.row_i, b.n, b.time_s, b.time_h, dut, {', '.join(raw(c) for c in resp)},
    {fixed} from walk b join shift using (device_id), level v),
  means as (select device_id, {', '.join(f'avg("{c}") as "m_{c}"' for c in resp)} from raw group by 1),
  base as materialized (select b.device_id, b.row_i, b.n, b.time_s, b.time_h,
    {', '.join(f'"m_{c}" + (b."{c}" - "m_{c}") * {duty} as "{c}"' for c in resp)},
    {', '.join(f'b."{c}"' for c in params)} from raw b join means using (device_id))""",
            windows((1.0, 4.0), (0.4, 1.0), per_day, False),
            f"""aimed as materialized (select k.*, {', '.join(f'{seg_value("s", c, "x")} as "t_{c}"' for c in resp)}
    from (select *, {low} + amplitude * ({high} - {low}) as x from (select *, {by_value('kind', kinds)} as axis
      from kept)) k left join {seg_join('s', 'k.axis', 'x')}),
  l1 as materialized (select b.device_id, b.row_i, b.n, b.time_s, b.time_h, coalesce(w.kind, 'normal') as ev,
    {', '.join(event(c) for c in resp)}, {', '.join(f'b."{c}"' for c in params)}
    from base b left join aimed w on {IN_WINDOW} {ANCHORS}),
  failing as (select device_id, n, ftype, {by_value('ftype', {k: v[1] for k, v in wear_of.items()})} as p_nom,
    {by_value('ftype', {k: v[2] for k, v in wear_of.items()})} as p_fail,
    {by_value('ftype', {k: v[0] for k, v in wear_of.items()})} as wear_column,
    21600.0::double * sev as span_s, cast(floor(21600.0::double * sev / {FREQ}) as bigint) as wear_rows,
    cast(floor(fday * 86400.0 / {FREQ}) as bigint) as fail_start from man where ftype is not null),
  crossing as (select device_id, min(fail_start + r) filter ({seg_value('s', speed, wear_at)}
      < 0.4 * (select "{speed}" from level)) as hit
    from (select *, unnest(range(0, wear_rows)) as r from failing) f
    join {seg_join('s', 'f.ftype', wear_at)} where fail_start + r < n group by 1),
  fails as (select f.* exclude (n), coalesce(hit, least(fail_start + wear_rows, n - 1)) as fail_row
    from failing f left join crossing using (device_id))""",
            PHASED,
            f"""done as (select b.device_id, b.row_i, b.time_s, b.time_h, {', '.join(finished(c) for c in [*resp, *params])},
    {labelled(1, "'failure_' || ftype").replace('row_i', 'b.row_i')}
    from phased b left join l1 z on z.device_id = b.device_id and z.row_i = 0
    left join {seg_join('s', 'b.ftype', wear)} and {active})""",
        ]
    ) + " " + final([*resp, *params], extra)


def sample_dataset(machine: str, build, days: float, *inputs) -> str:
    """Twin of a sample data set: the same build over four series per supplier."""
    failures = K.PUMP_FAILURES if machine == "pump" else K.MOTOR_FAILURES
    decoys = K.PUMP_DECOYS if machine == "pump" else K.MOTOR_DECOYS
    names = [("normal_long", None)] + [(f"{f}_failure_long", f) for f in failures]
    values = ", ".join(f"({i}, '{n}', {repr(f) if f else 'null'})" for i, (n, f) in enumerate(names))
    man = f"""named as (select s_suppkey || '_' || name as device_id, ftype from supplier,
    (values {values}) v(i, name, ftype)),
  man as materialized (select device_id, {days}::double as days,
    cast(floor({days} * 86400 / {FREQ}.0) as bigint) + 1 as n, {decoys} as types, ftype,
    {days}::double * (0.7 + {sql_u(WHO, 'default_start')} * (0.9::double - 0.7::double)) as fday,
    1.0::double as sev, 5.0::double as amb, 0.5::double as dut, 2.0::double as dfreq, 1.0::double as ns,
    0.0::double as vo, 0.0::double as po from named)"""
    number = "case " + " ".join(
        f"when \\1 like '%\\_{n}' escape '\\' then {i}".replace("\\\\1", "\\1")
        for i, (n, _) in enumerate(names)
    ) + " end"
    key = number.replace("\\1", "device_id")
    extra = f", cast(split_part(device_id, '_', 1) as bigint) as s_suppkey, {key} as scenario_id"
    sql = build(*inputs, days, man, 1.0 / 30.0, extra)
    seed = re.compile(r"\(12345 \+ cast\(right\(((?:\w+\.)?device_id), 6\) as bigint\)\)")
    return seed.sub(lambda m: f"(42 + {number.replace(chr(92) + '1', m.group(1))})", sql)


def scenarios(machine: str, catalogue) -> str:
    """CTE ``scen``: rows of every scenario of every supplier."""
    values = ", ".join(
        "({})".format(
            ", ".join([str(i)] + [f"'{v}'" if v is not None else "null" for v in row])
        )
        for i, row in enumerate(catalogue)
    )
    return f"""scen as (select s_suppkey, v.*, s_suppkey || '_' || scenario_id as device_id, row_i,
    row_i * {FREQ} as time_s, row_i * {FREQ} / 3600.0::double as time_h, kind = 'failure' as faulty
    from supplier, (values {values}) v(scenario_id, scenario, grp, kind, ftype, dtype), range(0, 73) r(row_i))"""


def scenario_labels(fail: str) -> str:
    return f"""case when {fail} is null then 'NORMAL' when row_i >= {fail} then 'FAILURE'
      when row_i >= greatest({fail} - 12, 0) then 'PRE_FAILURE' else 'NORMAL' end as label,
    case when {fail} is null or row_i < greatest({fail} - 12, 0) then -1.0::double
      else greatest({fail} - row_i, 0) * {FREQ}.0::double end as time_to_failure_s"""


SCENARIO_KEYS = "s_suppkey, scenario_id, scenario, row_i, time_s, time_h, label, time_to_failure_s"


def motor_scenarios(text, axes, catalogue) -> str:
    resp, params, sd = K.MOTOR_RESPONSES, K.MOTOR_PARAMS, K.MOTOR_NOISE_SD
    key = "'42|' || device_id || '|' || row_i"
    wear = worn("time_s::double", "p_nom", "p_fail", "21600.0::double")
    axis_of = by_value("dtype", K.MOTOR_DECOY_AXIS)
    low = by_value("axis", {a: v[0] for a, v in K.MOTOR_INPUTS.items()})
    high = by_value("axis", {a: v[1] for a, v in K.MOTOR_INPUTS.items()})
    shape = """case when dtype like '%ramp' then least(greatest((time_s - 7200) / 7200.0::double, 0), 1)
      else 1.0::double end"""
    pars = ", ".join(
        f"case when ftype = '{k}' then x else {v[1]!r}::double end as \"{v[0]}\"" for k, v in K.MOTOR_WEAR.items()
    )
    values = ", ".join(
        f"""round("{c}" + {sql_n(key, 'noise_' + c)} * {sd[c]} + sum({K.MOTOR_DRIFT_SD_SHORT}
      * {sql_n(key, 'drift_' + c)}) over (partition by device_id order by row_i), 6) + 0.0 as "{c}" """
        for c in resp
    )
    rest = ", ".join(f'round("{c}", 6) + 0.0 as "{c}"' for c in params)
    read = ", ".join(f'coalesce({seg_value("s", c, "x")}, v."{c}") as "{c}"' for c in resp)
    return "with " + ", ".join(
        [
            motor_inputs(text, axes),
            scenarios("motor", catalogue),
            f"""driven as (select *, case when faulty then {wear}
      when dtype is not null and time_s >= 7200 then {low} + {shape} * ({high} - {low}) end as x
    from (select *, coalesce(ftype, {axis_of}) as axis,
      {by_value('ftype', {k: v[1] for k, v in K.MOTOR_WEAR.items()})} as p_nom,
      {by_value('ftype', {k: v[2] for k, v in K.MOTOR_WEAR.items()})} as p_fail from scen)),
  clean as (select d.*, {read}, {pars} from driven d cross join level v
    left join {seg_join('s', 'd.axis', 'd.x')} and d.x is not null),
  hits as (select device_id, coalesce(min(row_i) filter ("{resp[0]}" / (select "{resp[0]}" from level) < 0.4),
    max(row_i)) as f from clean where faulty group by 1)
  select {SCENARIO_KEYS}, {values}, {rest} from (select c.*, {scenario_labels('f')}
    from clean c left join hits using (device_id))""",
        ]
    )


def pump_scenarios(text, catalogue) -> str:
    sd = K.PUMP_NOISE_SD
    key = "'42|' || device_id || '|' || row_i"
    signals = ", ".join(f'{t} as "{c}"' for c, t in text.items())

    def value(c):
        x = f'case when e.kind is not null then e."{c}" else p."{c}" end'
        return f"""round({x} + {sd[c]} * {sql_n(key, 'noise_' + c)}, 6) + 0.0 as "{c}" """

    return "with " + ", ".join(
        [
            pump_positions(signals),
            scenarios("pump", catalogue),
            f"""done as (select s.* exclude (kind), {', '.join(value(c) for c in text)},
    round(greatest({noisy('flow_in_m3s', sd, key)} - {noisy('flow_out_m3s', sd, key)}, 0.0), 6) + 0.0
      as flow_gap_m3s, case when faulty then max(row_i) over (partition by device_id) end as f
    from scen s join positions p on p.i = case when row_i < 48 then row_i else 48 + (row_i - 48) % 12 end
    left join episodes e on e.kind = case when faulty then 'failure_' || ftype else 'decoy_' || dtype end
      and e.idx = case when faulty then row_i else row_i - 24 end
    where not faulty or e.kind is not null)""",
        ]
    ) + f""" select {SCENARIO_KEYS}, {', '.join(f'"{c}"' for c in text)}, flow_gap_m3s
      from (select *, {scenario_labels('f')} from done)"""


def noisy(c, sd, key) -> str:
    x = f'case when e.kind is not null then e."{c}" else p."{c}" end'
    return f"({x} + {sd[c]} * {sql_n(key, 'noise_' + c)})"
