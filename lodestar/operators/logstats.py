"""Request-log analytics: frames, streaks, buckets and pacing as window functions and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trailing_count(rows: DataFrame, ts: str, seconds: int, keys: list[str], alias: str = "n_recent") -> DataFrame:
    """Rows within so many seconds before each row, itself and both ends included."""
    w = Window.partitionBy(*keys).orderBy(F.unix_micros(F.col(ts).cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    return rows.withColumn(alias, F.count("*").over(w))


def backoff(level: Column, storm: Column, cap: float = 300.0, jitter: Column | float = 1.0, retry_after: Column | None = None, throttled: Column | None = None, margin: Column | float = 2.0) -> Column:
    """Seconds to wait: 5 or 2, doubled with each level, to the cap, times the jitter.

    A longer Retry-After takes their place, with the margin; the rest of a
    throttle that ends later holds the request until then, with the margin.
    """
    wait = F.least(F.lit(cap), F.when(storm, 5.0).otherwise(2.0) * F.pow(F.lit(2.0), level)) * jitter
    for other in (retry_after, throttled):
        if other is not None:
            wait = F.when(other > wait, other + margin).otherwise(wait)
    return wait


def streaks(rows: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """Each row's place in its streak: a gap of more than ``gap_seconds`` starts a new one."""
    order = Window.partitionBy(key).orderBy(ts, "event_id")
    gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.lag(F.unix_micros(F.col(ts).cast("timestamp"))).over(order)
    out = rows.withColumn("island", F.sum(F.when(gap > gap_seconds * 1_000_000, 1).otherwise(0)).over(order))
    return out.withColumn("streak", F.row_number().over(Window.partitionBy(key, "island").orderBy(ts, "event_id")))


def rolling_latency(rows: DataFrame, key: str, order: list[str], cents: str, size: int = 50, least: int = 5) -> DataFrame:
    """Sum, count and floor-rank 90th percentile of the last ``size`` values, and the pace they call for.

    From ``least`` values on: slow for a mean over 3.00 or a percentile over 5.00, fast for a mean under 1.20.
    """
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(-(size - 1), 0)
    out = rows.withColumns({"n": F.count(cents).over(w), "total": F.sum(cents).over(w), "__all": F.array_sort(F.collect_list(cents).over(w))})
    out = out.withColumn("p90", F.get("__all", F.floor(F.lit(0.9) * (F.col("n") - 1)).cast("int"))).drop("__all")
    return out.withColumn(
        "pace",
        F.when(F.col("n") < least, "none")
        .when((F.col("total") > 300 * F.col("n")) | (F.col("p90") > 500), "slow")
        .when(F.col("total") < 120 * F.col("n"), "fast")
        .otherwise("steady"),
    )


def exhaustion(pages: DataFrame) -> DataFrame:
    """(topic, exhausted_at): the first page without guides that has no next, follows an empty one or is the last known."""
    order = Window.partitionBy("topic").orderBy("page")
    over = (F.col("guides") == 0) & (~F.col("has_next") | (F.lag("guides").over(order) == 0) | (F.col("page") >= F.col("total_pages")))
    return pages.withColumn("over", F.coalesce(over, F.lit(False))).groupBy("topic").agg(F.min(F.when(F.col("over"), F.col("page"))).alias("exhausted_at"))


def token_bucket(rows: DataFrame, key: str, order: str, micros: str, capacity: float = 12.0, initial: float = 8.4, per_second: float = 1.2) -> DataFrame:
    """(key, admitted, delayed): arrivals that find a whole token.  Each key's arrivals are folded in order."""
    arrivals = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, F.col(micros).alias("us")))).alias("a"))
    fold = F.expr(
        f"""aggregate(a, named_struct('t', cast(null as bigint), 'have', cast({initial} as double), 'yes', 0L, 'no', 0L),
             (s, x) -> named_struct('t', x.us,
               'have', bucket_left(s.t, s.have, x.us), 'yes', s.yes, 'no', s.no))"""
        .replace("bucket_left(s.t, s.have, x.us)", _left(capacity, per_second))
        .replace("'yes', s.yes", f"'yes', s.yes + if({_full(capacity, per_second)} >= 1D, 1L, 0L)")
        .replace("'no', s.no)", f"'no', s.no + if({_full(capacity, per_second)} >= 1D, 0L, 1L))")
    )
    return arrivals.select(key, fold.alias("s")).select(key, F.col("s.yes").alias("admitted"), F.col("s.no").alias("delayed"))


def _full(capacity: float, per_second: float) -> str:
    return f"least({capacity}D, s.have + {per_second}D * (greatest(0L, coalesce(x.us - s.t, 0L)) / 1000000D))"


def _left(capacity: float, per_second: float) -> str:
    full = _full(capacity, per_second)
    return f"if({full} >= 1D, {full} - 1D, {full})"


def page_barrier(rows: DataFrame, topic: str, page: str, done: str) -> DataFrame:
    """When each page is complete, and when the next may start: as its last item is done."""
    pages = rows.groupBy(topic, page).agg(F.count("*").alias("n_items"), F.max(done).alias("complete_at"))
    return pages.withColumn("opened_at", F.lag("complete_at").over(Window.partitionBy(topic).orderBy(page)))


def stalls(rows: DataFrame, key: str, ts: str, seconds: int) -> DataFrame:
    """Rows that come more than so many seconds after the row before them."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = micros - F.lag(micros).over(Window.partitionBy(key).orderBy(ts, "event_id"))
    return rows.withColumn("gap_us", gap).where(F.col("gap_us") > seconds * 1_000_000)


def _folded(rows: DataFrame, key: str, item: Column, start: str, step: str) -> DataFrame:
    """(key, s): the SQL expression ``step`` of (state s, item x) folded over each key's items in their order."""
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("__a")).select(key, F.expr(f"aggregate(__a, {start}, (s, x) -> {step})").alias("s"))


def storm_machine(
    rows: DataFrame, key: str, micros: str, window_s: int = 300, calm_s: int = 60, first_cool: float = 75.0, cool: float = 67.5, extend: float = 20.0, many: int = 5, most: int = 6, refill: float = 1.2
) -> DataFrame:
    """(key, storms, extensions, calm_us, level, refill): the 429 state machine over each key's hits, with mean cool-off times.

    A hit that stands alone in the window, or is one of ``many``, starts a storm
    where none is on; one within a storm's cool-off extends it, ``most`` times
    at most, raises the retry level to 8 at most and lowers the refill rate to a
    fifth at least.  A hit after the cool-off ends the storm first, and only the
    hits of the last ``calm_s`` seconds are remembered then.  The state holds
    the last ``many`` hits, enough to tell all of that.
    """
    second = 1_000_000
    # What a hit finds: an ended storm is over, old hits are forgotten.
    found = f"""named_struct('on', s.on and x < s.until, 'until', s.until, 'ext', if(s.on and x >= s.until, 0, s.ext), 'level', if(s.on and x >= s.until, 0, s.level),
        'hits', slice(reverse(filter(concat(s.hits, array(x)), h -> h >= x - {window_s * second}L and not (s.on and x >= s.until and h <= x - {calm_s * second}L))), 1, {many}),
        'storms', s.storms, 'total', s.total, 'refill', s.refill)"""
    starts = f"(not f.on and (size(f.hits) = 1 or size(f.hits) >= {many}))"
    extends = f"(f.on and f.ext < {most})"
    after = f"""transform(array({found}), f -> named_struct('on', f.on or {starts},
        'until', case when {starts} then x + if(size(f.hits) = 1, {int(first_cool * second)}L, {int(cool * second)}L) when {extends} then f.until + {int(extend * second)}L else f.until end,
        'ext', f.ext + if({extends}, 1, 0), 'level', case when {starts} then 1 when {extends} then least(8, f.level + 1) else f.level end,
        'hits', reverse(f.hits), 'storms', f.storms + if({starts}, 1L, 0L), 'total', f.total + if({extends}, 1L, 0L),
        'refill', if({extends}, greatest({refill}D * 0.2D, f.refill * 0.85D), f.refill)))[0]"""
    start = f"named_struct('on', false, 'until', -1L, 'ext', 0, 'level', 0, 'hits', cast(array() as array<bigint>), 'storms', 0L, 'total', 0L, 'refill', {refill}D)"
    done = _folded(rows, key, F.col(micros).cast("long"), start, after)
    return done.select(key, "s.storms", F.col("s.total").alias("extensions"), F.col("s.until").alias("calm_us"), "s.level", "s.refill")


def admission(arrivals: DataFrame, key: str, order: str, micros: str, global_gap: float = 0.8, guide_gap: float = 1.0, jitter: float = 0.2, cap: int = 6) -> DataFrame:
    """(key, admitted and what else held a request back): the gates that each key's arrivals meet, counted.

    ``arrivals`` also has throttle_us (the end of a throttle), storm and
    in_flight, as they are when a request arrives.  A request is held by the
    first of: the gap to the last request of any kind, the gap to the last
    detail request, the throttle, the storm, the cap.  One held by the second
    gap moves it: the next counts from when that one is ready.  One that reaches
    the cap has passed both gaps, so their times move though it is held.
    """
    gaps = [int(x * 1_000_000) for x in (global_gap, guide_gap, jitter)]
    item = F.struct(order, F.col(micros).alias("t"), "throttle_us", "storm", "in_flight")
    gate = f"""case when s.any + {gaps[0]}L > x.t then 1 when s.guide + {gaps[1]}L > x.t then 2 when x.t < x.throttle_us then 3 when x.storm then 4 when x.in_flight >= {cap} then 5 else 0 end"""
    step = f"""transform(array({gate}), g -> named_struct('any', if(g in (0, 5), x.t, s.any), 'guide', case when g in (0, 5) then x.t when g = 2 then s.guide + {gaps[1] + gaps[2]}L else s.guide end,
        'n', transform(s.n, (c, i) -> c + if(i = g, 1L, 0L))))[0]"""
    done = _folded(arrivals, key, item, f"named_struct('any', -{1 << 60}L, 'guide', -{1 << 60}L, 'n', array_repeat(0L, 6))", step)
    names = ["admitted", "global_gap", "guide_gap", "throttle", "storm", "in_flight"]
    return done.select(key, *[F.col("s.n")[i].alias(n) for i, n in enumerate(names)])


def pacing(windows: DataFrame, key: str, order: str, hits: str, refill: float = 1.2, base_refill: float = 1.2) -> DataFrame:
    """(key, global_gap, guide_gap, refill) after each key's summary windows, which ``windows`` has without holes.

    Every hit makes the gaps longer; from the second clean window in a row on
    they get shorter and the refill rate goes back to its base; the row of clean
    windows starts anew with a hit, and when the global gap has changed by a hundredth.
    """
    step = f"""if(x.{hits} > 0, named_struct('g', least(15D, s.g * pow(1.2D, x.{hits})), 'd', least(5D, s.d * pow(1.25D, x.{hits})), 'r', s.r, 'clean', 0),
        if(s.clean >= 1, named_struct('g', greatest(0.3D, s.g * 0.9D), 'd', greatest(0.5D, s.d * 0.9D), 'r', if(s.r < {base_refill}D, least({base_refill}D, s.r * 1.15D), s.r),
            'clean', if(floor(s.g * 100) != floor(greatest(0.3D, s.g * 0.9D) * 100), 0, s.clean + 1)),
          named_struct('g', s.g, 'd', s.d, 'r', s.r, 'clean', s.clean + 1)))"""
    done = _folded(windows, key, F.struct(order, hits), f"named_struct('g', 0.8D, 'd', 1.0D, 'r', {refill}D, 'clean', 0)", step)
    return done.select(key, F.col("s.g").alias("global_gap"), F.col("s.d").alias("guide_gap"), F.col("s.r").alias("refill"))


def captcha(rows: DataFrame, key: str, ts: str, gap_s: int = 120, window_s: int = 900, many: int = 3, cool: float = 120.0, more: float = 180.0) -> DataFrame:
    """``streaks`` with n_recent, the cool-off (mean times; longer for ``many`` in the window) and the gaps that a streak calls for."""
    out = trailing_count(streaks(rows, key, ts, gap_s), ts, window_s, [key])
    streak = F.least(F.col("streak"), F.lit(6)).cast("double")
    return out.withColumns(
        {
            "cool": F.lit(cool) + F.when(F.col("n_recent") >= many, more).otherwise(0.0),
            "global_target": F.least(F.lit(15.0), 0.3 * F.pow(F.lit(1.5), streak)),
            "guide_target": F.least(F.lit(6.0), 0.5 * F.pow(F.lit(1.6), streak)),
        }
    )


def latency_pacing(paced: DataFrame, key: str, order: list[str], refill: float = 1.2, gap: float = 0.8) -> DataFrame:
    """(key, refill, global_gap) after the paces of ``rolling_latency``: slow ones lower the rate and lengthen the gap, fast ones do the reverse."""
    step = """case x.pace when 'slow' then named_struct('r', greatest(0.4D, s.r * 0.9D), 'g', least(15D, s.g * 1.1D))
        when 'fast' then named_struct('r', least(3D, s.r * 1.05D), 'g', greatest(0.3D, s.g * 0.95D)) else s end"""
    done = _folded(paced, key, F.struct(*order, "pace"), f"named_struct('r', {refill}D, 'g', {gap}D)", step)
    return done.select(key, F.col("s.r").alias("refill"), F.col("s.g").alias("global_gap"))


def release_order(delayed: DataFrame, ready: str, seq: str, batch: int = 3) -> DataFrame:
    """``delayed`` with the idle tick in which each is released: one queue by (ready time, sequence), ``batch`` to a tick, none before it is ready.

    Ranks are counted within ranges of the order and the ranges' counts summed, so no task sorts the whole queue.
    """
    parts = delayed.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = delayed.repartitionByRange(int(parts), ready, seq).withColumn("__part", F.spark_partition_id())
    within = dealt.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy(ready, seq)))
    before = Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    offsets = within.groupBy(F.col("__part").alias("__of")).agg(F.count("*").alias("__rows")).select("__of", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    place = F.col("__offset") + F.col("__n") - 1
    return within.join(F.broadcast(offsets), F.col("__part") == F.col("__of")).withColumn("tick", F.floor(place / batch).cast("long")).drop("__part", "__n", "__of", "__offset")
