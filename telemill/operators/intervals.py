"""Event windows: scheduling, overlap removal, and laying them over rows.

Windows are half-open row ranges ``[start_row, end_row)`` per device. They are
joined to rows on (device, bucket of rows) so a row is compared with the few
windows that touch its bucket, and a device with very many rows or windows is
still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import Draws
from ..session import materialize
from .spine import row_count

BUCKET = (1, 1440)


def bucket_of(row: str, bucket: tuple[int, int] = BUCKET) -> str:
    """SQL text of ``row * a div b``, rounded down: with (seconds per row, 86400) it is the day."""
    a, b = int(bucket[0]), int(bucket[1])
    return f"((({row}) * {a} - pmod(({row}) * {a}, {b}L)) div {b})"


def in_buckets(
    windows: DataFrame, start: str, end: str, bucket: tuple[int, int] = BUCKET
) -> DataFrame:
    """One copy of each window per row bucket it touches, as ``_bucket``."""
    first, last = bucket_of(f"`{start}`", bucket), bucket_of(f"`{end}` - 1", bucket)
    return windows.where(F.col(end) > F.col(start)).withColumn(
        "_bucket", F.explode(F.expr(f"sequence({first}, {last})"))
    )


def lay_over(
    rows: DataFrame,
    windows: DataFrame,
    key: str = "device_id",
    row: str = "row_i",
    start: str = "start_row",
    end: str = "end_row",
    bucket: tuple[int, int] = BUCKET,
    bucket_col: str | None = None,
    how: str = "left",
) -> DataFrame:
    """Attach to each row the windows that hold it.

    A column name that both sides have keeps the row's value. Rows already laid out by (key, ``bucket_col``) are not moved again.
    """
    at = bucket_col or "_at_bucket"
    left = rows if bucket_col else rows.withColumn(at, F.expr(bucket_of(f"`{row}`", bucket)))
    shared = [c for c in windows.columns if c in rows.columns and c != key]
    right = in_buckets(windows.drop(*shared), start, end, bucket).withColumnRenamed(key, "_key")
    on = (
        (F.col(key) == F.col("_key"))
        & (F.col(at) == F.col("_bucket"))
        & (F.col(row) >= F.col(start))
        & (F.col(row) < F.col(end))
    )
    return left.join(right, on, how).drop("_key", "_bucket", *([] if bucket_col else [at]))


def lay_over_spans(
    spans: DataFrame,
    windows: DataFrame,
    name: str,
    bucket: tuple[int, int],
    bucket_col: str,
    key: str = "device_id",
    start: str = "start_row",
    end: str = "end_row",
) -> DataFrame:
    """``lay_over`` for spans of rows (``_from`` to ``_to``) that are opened later, each inside one bucket.

    A span is cut where a window starts or ends, so a piece lies in the same windows as a
    whole. They come as an array of structs ``name``: empty or null where there are none.
    """
    held = (
        in_buckets(windows, start, end, bucket)
        .groupBy(F.col(key).alias("_key"), "_bucket")
        .agg(F.collect_list(F.struct(*[c for c in windows.columns if c != key])).alias("_held"))
    )
    edges = F.flatten(F.transform("_held", lambda w: F.array(w[start], w[end])))
    inner = F.filter(edges, lambda x: (x > F.col("_from")) & (x <= F.col("_to")))
    starts = F.array_sort(F.array_distinct(F.concat(F.array("_from"), F.coalesce(inner, F.array().cast("array<bigint>")))))
    pieces = F.transform(
        "_starts",
        lambda x, i: F.struct(x.alias("f"), F.coalesce(F.get("_starts", i + 1) - 1, F.col("_to")).alias("t")),
    )
    on = (F.col(key) == F.col("_key")) & (F.col(bucket_col) == F.col("_bucket"))
    return (
        spans.join(held, on, "left")
        .withColumn("_starts", starts)
        .withColumn("_piece", F.explode(pieces))
        .withColumns({"_from": F.col("_piece.f"), "_to": F.col("_piece.t")})
        .withColumn(name, F.filter("_held", lambda w: (w[start] <= F.col("_from")) & (w[end] > F.col("_from"))))
        .drop("_key", "_bucket", "_held", "_starts", "_piece")
    )


def poisson_events(
    devices: DataFrame, rate_per_day: Column, days: Column, draws: Draws, stream: str
) -> DataFrame:
    """Event times of a Poisson process: one row per event, ``event_no``, ``time_s``.

    Drawn day by day, which is equal in law to one draw over the whole span and
    spreads a single device over many tasks. The last part-day has its share of
    the rate. ``event_day``/``event_in_day`` name the event for further draws.
    """
    key = "device_id"
    spread = (
        devices.withColumn("_days", days.cast("double"))
        .withColumn("_rate", rate_per_day.cast("double"))
        .where("_days > 0 and _rate > 0")
        .withColumn(
            "event_day",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil("_days").cast("bigint") - 1)),
        )
        .withColumn("_part", F.least(F.lit(1.0), F.col("_days") - F.col("event_day")))
    )
    counted = spread.withColumn(
        "_n",
        draws.poisson(F.col("_rate") * F.col("_part"), [key, "event_day"], f"{stream}_count"),
    )
    numbers = F.when(F.col("_n") > 0, F.sequence(F.lit(1), F.col("_n")))
    timed = counted.withColumn("event_in_day", F.explode(numbers)).withColumn(
        "time_s",
        (
            F.col("event_day")
            + F.col("_part") * draws.uniform([key, "event_day", "event_in_day"], f"{stream}_time")
        )
        * 86400.0,
    )
    return timed.drop("_days", "_rate", "_part", "_n")


def schedule(
    devices: DataFrame,
    kind: str,
    draws: Draws,
    freq_s: int,
    rate_per_day: Column,
    hours: tuple[float, float],
    days: str = "duration_days",
    types: Column | None = None,
    amplitude: tuple[float, float] | None = None,
    episode_rows: int | None = None,
) -> DataFrame:
    """Proposed windows of one kind, those that would run past the end left out.

    ``hours`` bounds the uniform duration. ``types`` is an array column to choose
    the event type from, ``amplitude`` bounds a uniform strength. With
    ``episode_rows`` a window stops early when its episode runs out; the
    untrimmed end is kept as ``proposed_end``.
    """
    who = ["device_id", "event_day", "event_in_day"]
    events = poisson_events(devices, rate_per_day, F.col(days), draws, kind)
    rows = row_count(F.col(days), freq_s)
    length = F.floor(
        draws.uniform(who, f"{kind}_hours", *hours) * 3600.0 / F.lit(float(freq_s))
    ).cast("bigint")
    out = (
        events.withColumn("_rows", rows)
        .withColumn("start_row", F.floor(F.col("time_s") / freq_s).cast("bigint"))
        .withColumn("proposed_end", F.col("start_row") + length)
        .where("proposed_end < _rows and proposed_end > start_row")
        .drop("_rows")
    )
    end = F.col("proposed_end")
    if episode_rows is not None:
        end = F.least(end, F.col("start_row") + F.lit(int(episode_rows)))
    out = out.withColumn("end_row", end)
    if types is None:
        out = out.withColumn("kind", F.lit(kind))
    else:
        out = out.withColumn(
            "kind", F.concat(F.lit(f"{kind}_"), draws.choice(types, who, f"{kind}_type"))
        )
    if amplitude is not None:
        out = out.withColumn("amplitude", draws.uniform(who, f"{kind}_amplitude", *amplitude))
    return out


def clear_of(
    windows: DataFrame,
    existing: DataFrame,
    key: str = "device_id",
    start: str = "start_row",
    end: str = "end_row",
    ids: Sequence[str] = ("event_day", "event_in_day"),
    bucket: tuple[int, int] = BUCKET,
) -> DataFrame:
    """Windows that overlap no window of ``existing`` (``start_row``, ``end_row``)."""
    mine = in_buckets(windows.select(key, *ids, start, end), start, end, bucket)
    theirs = in_buckets(
        existing.select(
            F.col(key).alias("_k"), F.col("start_row").alias("_s"), F.col("end_row").alias("_e")
        ),
        "_s",
        "_e",
        bucket,
    ).withColumnRenamed("_bucket", "_b")
    hit = mine.join(
        theirs,
        (F.col(key) == F.col("_k"))
        & (F.col("_bucket") == F.col("_b"))
        & (F.col(start) < F.col("_e"))
        & (F.col("_s") < F.col(end)),
        "left_semi",
    )
    return windows.join(hit.select(key, *ids).distinct(), [key, *ids], "left_anti")


#: Windows that are folded at a time, and buckets that make one group of each level between them and the device.
PIECE = 256
SPANS = (4096,)
_NEVER = -(1 << 63)


def non_overlapping(
    windows: DataFrame,
    key: str = "device_id",
    start: str = "start_row",
    end: str = "end_row",
    ids: Sequence[str] = ("event_day", "event_in_day"),
    bucket: tuple[int, int] = BUCKET,
) -> DataFrame:
    """Walk each device's windows in time order, dropping any that overlaps a kept one.

    ``start`` and ``ids`` together name a window of a device; windows without start or end
    are dropped. An empty window is kept where no kept window before it reaches over it.

    A window turns "free from t on" into "free from its end on" if it starts no earlier than t, and
    leaves t alone otherwise. A run of windows is a map of that kind too, written as steps:
    for entries up to ``t`` the walk leaves at ``x``. Maps of pieces are composed by spans of
    buckets up to the whole device; then entries are handed down again. A map only has the
    steps that a window before it can lead to, so every level reads few rows per piece.
    """
    names, node = windows.columns, F.struct(start, *ids)
    stored = materialize(windows, "windows")
    real = stored.where(F.col(end) > F.col(start))
    firsts = real.groupBy(key, start).agg(F.min(F.struct(*ids, end)).alias("_f")).select(
        key, F.expr(bucket_of(f"`{start}`", bucket)).alias("_b"), F.col(start).cast("bigint").alias("_t"),
        F.col(f"_f.`{end}`").cast("bigint").alias("_x"), F.struct(start, *[F.col(f"_f.`{c}`") for c in ids]).alias("_node"),
    )
    pieces = materialize(_pieces(firsts, key, bucket), "window-pieces")
    levels = [_maps(pieces, _by_window, F.transform("_children", lambda c: c["t"]))]
    groups = []
    for span in SPANS:
        below = levels[-1].withColumn("_g", F.expr(f"_b - pmod(_b, {span}L)")).groupBy(key, "_g").agg(*_children())
        groups.append(below)
        starts = F.flatten(F.transform("_children", lambda c: F.transform(c["steps"], lambda s: s["t"])))
        levels.append(_maps(below.select(key, F.col("_g").alias("_b"), F.lit(0).alias("_p"), "_children", "_reach"), _by_steps, starts))
    entries = _handed_down(levels[-1].groupBy(key).agg(*_children()).withColumn("_entry", F.lit(_NEVER)), key)
    for below in reversed(groups):
        entry = entries.select(F.col(key).alias("_k"), F.col("_b").alias("_g0"), "_entry")
        entries = _handed_down(below.join(entry, (F.col(key) == F.col("_k")) & (F.col("_g") == F.col("_g0"))), key)
    entry = entries.select(F.col(key).alias("_k"), F.col("_b").alias("_b0"), F.col("_p").alias("_p0"), "_entry")
    entered = pieces.join(entry, (F.col(key) == F.col("_k")) & (F.col("_b") == F.col("_b0")) & (F.col("_p") == F.col("_p0")))
    kept = (
        entered.select(key, F.explode(F.arrays_zip("_children", _running(_by_window).alias("_entries"))).alias("_w"))
        .where("_w._children.t >= _w._entries")
        .select(key, F.col("_w._children.t").alias("_t"), F.col("_w._children.x").alias("_x"), F.col("_w._children.node").alias("_node"))
    )
    walked = real.withColumn("_node", node).join(kept.select(key, "_node"), [key, "_node"], "left_semi")
    over = in_buckets(kept, "_t", "_x", bucket).select(F.col(key).alias("_k"), "_bucket", "_x", F.col("_node").alias("_over"))
    empty = stored.where(F.col(end) <= F.col(start)).withColumn("_node", node).withColumn("_at", F.expr(bucket_of(f"`{start}`", bucket)))
    hidden = (F.col(key) == F.col("_k")) & (F.col("_at") == F.col("_bucket")) & (F.col("_x") > F.col(start)) & (F.col("_over") < F.col("_node"))
    return walked.select(*names).unionByName(empty.join(over, hidden, "left_anti").select(*names))


def _pieces(firsts: DataFrame, key: str, bucket: tuple[int, int]) -> DataFrame:
    """``_children`` (windows, at most ``PIECE``, by start) of every piece ``_p`` of a bucket ``_b``.

    ``_reach`` is how far a window that starts before the piece goes into it.
    """
    last = F.expr(bucket_of("_x - 1", bucket))
    reaching = (
        firsts.where(last > F.col("_b")).select(key, F.explode(F.sequence(F.col("_b") + 1, last)).alias("_b"), "_x")
        .groupBy(key, "_b").agg(F.max("_x").alias("_x"))
    )
    by_start = Window.partitionBy(key, "_b").orderBy(F.col("_t").asc_nulls_first())
    return (
        firsts.unionByName(reaching, allowMissingColumns=True)
        .withColumn("_p", F.floor(F.row_number().over(by_start) / PIECE))
        .withColumn("_before", F.max("_x").over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
        .where("_t is not null")
        .groupBy(key, "_b", "_p")
        .agg(
            F.array_sort(F.collect_list(F.struct(F.col("_t").alias("t"), F.col("_x").alias("x"), F.col("_node").alias("node")))).alias("_children"),
            F.min_by("_before", "_t").alias("_reach"),
        )
    )


def _by_window(window: Column, t: Column) -> Column:
    return F.when(window["t"] >= t, window["x"]).otherwise(t)


def _by_steps(child: Column, t: Column) -> Column:
    return F.coalesce(F.get(F.filter(child["steps"], lambda s: s["t"] >= t), F.lit(0))["x"], t)


def _children() -> list[Column]:
    """The maps of a group in order, and how far windows from before reach into the first one."""
    child = F.struct(F.col("_b").alias("b"), F.col("_p").alias("p"), F.col("_steps").alias("steps"))
    return [
        F.array_sort(F.collect_list(child)).alias("_children"),
        F.min_by("_reach", F.struct("_b", "_p")).alias("_reach"),
    ]


def _maps(groups: DataFrame, through, starts: Column) -> DataFrame:
    """``_steps`` (entries up to ``t`` leave at ``x``) of every group, composed of those of its children.

    A walk comes in at ``_reach`` or before, so the first step from there on is the last one needed.
    """
    def leave(t):
        return F.aggregate("_children", t, lambda at, child: through(child, at))

    bounded = groups.withColumn("_starts", starts).withColumn(
        "_bound", F.array_min(F.filter("_starts", lambda t: t >= F.coalesce("_reach", F.lit(_NEVER))))
    )
    steps = F.transform(
        F.filter("_starts", lambda t: F.col("_bound").isNull() | (t <= F.col("_bound"))),
        lambda t: F.struct(t.alias("t"), leave(t).alias("x")),
    )
    ends = F.filter("_all", lambda s, i: ~F.coalesce(F.get("_all", i + 1)["x"] == s["x"], F.lit(False)))
    return bounded.withColumn("_all", steps).withColumn("_steps", ends).drop("_children", "_starts", "_bound", "_all")


def _running(through) -> Column:
    """For every child the place from which on the walk is free when it comes there, and where it leaves the last one."""
    return F.aggregate(
        "_children", F.array("_entry"),
        lambda at, child: F.concat(at, F.array(through(child, F.element_at(at, -1)))),
    )


def _handed_down(groups: DataFrame, key: str) -> DataFrame:
    """``_entry`` of every child of groups with an ``_entry``."""
    zipped = F.explode(F.arrays_zip("_children", _running(_by_steps).alias("_entries"))).alias("_c")
    return groups.select(key, zipped).where("_c._children is not null").select(
        key, F.col("_c._children.b").alias("_b"), F.col("_c._children.p").alias("_p"), F.col("_c._entries").alias("_entry")
    )


def fit_windows(
    maintenance: DataFrame, decoys: DataFrame, bucket: tuple[int, int] = BUCKET
) -> tuple[DataFrame, DataFrame]:
    """Maintenance first, then the decoys that fit between: both walked, both stored."""
    m = materialize(non_overlapping(maintenance, bucket=bucket), "maintenance")
    free = clear_of(decoys, m, end="proposed_end", bucket=bucket)
    return m, materialize(non_overlapping(free, bucket=bucket), "decoys")


def resolve_events(
    rows: DataFrame,
    windows: DataFrame,
    priority: Sequence[str],
    default: str = "normal",
    key: str = "device_id",
    bucket: tuple[int, int] = BUCKET,
) -> DataFrame:
    """Event type per row where windows overlap: the last name in ``priority`` wins.

    ``windows`` has ``kind``; a kind is ranked by its whole name or by its part
    before the first underscore. Of two windows of one rank the one that starts later
    wins, then the one that ends later, then the later name. The windows are first cut into pieces that do
    not overlap, so each row meets one piece at most and no row is moved for it.
    """
    ranks = {name: i for i, name in enumerate(priority)}
    whole, head = F.col("kind"), F.substring_index("kind", "_", 1)
    rank = F.coalesce(*[F.when(whole == n, F.lit(i)) for n, i in ranks.items()])
    rank = F.coalesce(rank, *[F.when(head == n, F.lit(i)) for n, i in ranks.items()], F.lit(-1))
    placed = in_buckets(
        windows.select(
            key,
            F.col("start_row").alias("_s"),
            F.col("end_row").alias("_e"),
            F.struct(rank.alias("r"), F.col("start_row").alias("s"), F.col("end_row").alias("e"), "kind").alias("_event"),
        ),
        "_s",
        "_e",
        bucket,
    )
    near = Window.partitionBy(key, "_bucket").orderBy("_from")
    pieces = (
        placed.select(key, "_bucket", F.explode(F.array("_s", "_e")).alias("_from"))
        .distinct()
        .withColumn("_to", F.lead("_from").over(near))
        .where(F.col("_to").isNotNull())
    )
    best = (
        pieces.join(placed, [key, "_bucket"])
        .where((F.col("_s") <= F.col("_from")) & (F.col("_e") >= F.col("_to")))
        .groupBy(key, "_bucket", "_from", "_to")
        .agg(F.max("_event").alias("_best"))
    )
    stored = materialize(
        best.select(key, "_bucket", "_from", "_to", F.col("_best.kind").alias("_kind")), "event-pieces"
    )
    at = F.expr(bucket_of("`row_i`", bucket))
    right = stored.withColumnRenamed(key, "_key")
    on = (
        (F.col(key) == F.col("_key"))
        & (at == F.col("_bucket"))
        & (F.col("row_i") >= F.col("_from"))
        & (F.col("row_i") < F.col("_to"))
    )
    return (
        rows.join(right, on, "left")
        .withColumn("event_type", F.coalesce("_kind", F.lit(default)))
        .drop(*right.columns)
    )
