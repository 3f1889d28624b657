"""Event-time window counting.

``window_count`` is the batch form of the reference's keyed and whole-stream
tumbling/sliding windows followed by an incremental count.  Three physical plans
give identical rows:

``sweep``   (default when size is a multiple of slide)
    Count per (key, slide bucket) with partial aggregation, turn every bucket into
    a ``+c`` change point where its first window ends and a ``-c`` point after its
    last one, run a prefix sum over the change points and expand each constant run
    into its window ends.  Work is proportional to buckets, not to
    ``events x size/slide``.  The prefix sum is partitioned by (key, chunk of
    ``chunk_slides`` window ends); a bucket whose windows cross a chunk start emits
    its ``+c`` at that start, so every chunk is self-contained.  A keyless total or
    one hot key is therefore spread over ``time range / chunk`` tasks, and a task
    never holds more than ``2 * (chunk + size/slide)`` change points, whatever the
    event volume.

``explode`` count per bucket, then copy each bucket count into its ``size/slide``
    windows and sum.  Exact for any additive measure; used as a cross-check.

``window``  Spark's ``F.window`` expansion of every event; the only choice when the
    size is not a multiple of the slide.

Windows are ``[start, end)`` aligned to the Unix epoch, as in the reference and
in Spark's ``window``; an event exactly at a window end belongs to the next one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickstream.functions.eventtime import duration_us, epoch_us, from_epoch_us, is_ntz, ts_is_timestamp


#: Windows per event (size / slide) from which :func:`window_top_n` ranks segments.
SEGMENTS_FROM = 48


def floor_div(c: Column, n: int) -> Column:
    """Exact floor division of a long column by a positive constant."""
    # integer division truncates; the remainder is taken out first (no doubles, exact for every long)
    return F.call_function("div", c - F.pmod(c, F.lit(n)), F.lit(n))


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    if isinstance(keys, str):
        return [keys]
    return list(keys)


def bucketed(df: DataFrame, ts: str, width_us: int, keys: Sequence[str] = (), name: str = "_b") -> DataFrame:
    """Project ``keys`` plus the epoch bucket number of ``ts`` for a bucket of ``width_us`` microseconds."""
    return (df.where(F.col(ts).isNotNull())  # an event without a time is in no window
            .select(*_keys(keys), floor_div(epoch_us(df, ts), width_us).alias(name)))


def window_count(df: DataFrame, ts: str, size, slide=None, keys: Sequence[str] | str = (),
                 method: str = "auto", count_col: str = "cnt",
                 chunk_slides: int | None = None) -> DataFrame:
    """Count rows per (keys, window).

    Returns ``keys..., window_start, window_end, <count_col>`` with one row per
    window that holds at least one row.  ``size``/``slide`` are durations
    (``"1 hour"``, ``"5 minutes"``, seconds as a number); ``slide=None`` is a
    tumbling window.
    """
    keys = _keys(keys)
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    if size_us <= 0 or slide_us <= 0:
        raise ValueError("window size and slide must be positive")
    ntz = is_ntz(df, ts)
    divisible = size_us % slide_us == 0
    if method == "auto":
        method = "sweep" if divisible else "window"
    if method in ("sweep", "explode") and not divisible:
        raise ValueError(f"method={method} needs size to be a multiple of slide")

    if method == "window":
        return _window_plan(df, ts, size_us, slide_us, keys, count_col)

    ends = _window_ends(df, ts, size_us, slide_us, keys, method, chunk_slides)
    return _with_bounds(ends, keys, size_us, slide_us, ntz).withColumn(count_col, F.col("_v").cast("long")) \
        .select(*keys, "window_start", "window_end", count_col)


def _window_ends(df: DataFrame, ts: str, size_us: int, slide_us: int, keys: list[str], method: str,
                 chunk_slides: int | None) -> DataFrame:
    """``(keys, _e, _v)``: count ``_v`` of the window ending at ``_e * slide``."""
    n = size_us // slide_us
    counts = (bucketed(df, ts, slide_us, keys)
              .groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c")))
    if n == 1:
        return counts.select(*keys, (F.col("_b") + 1).alias("_e"), F.col("_c").alias("_v"))
    if method == "explode":
        return (counts
                .select(*keys, F.explode(F.sequence(F.col("_b") + 1, F.col("_b") + n)).alias("_e"), "_c")
                .groupBy(*keys, "_e").agg(F.sum("_c").alias("_v")))
    return _sweep(_intervals(counts, n), keys, chunk_slides or max(8 * n, 4096))


def window_unique(df: DataFrame, ts: str, user: str, size, slide=None, keys: Sequence[str] | str = (), out: str = "uv",
                  chunk_slides: int | None = None) -> DataFrame:
    """Exact distinct ``user`` per (keys, window), for sliding windows without copying events.

    A user seen in slide bucket b is in the windows ending at b+1 .. b+n.  From the user's
    next bucket on the windows are that bucket's, so each bucket is cut there and the union
    of a user's windows becomes disjoint intervals; summed as change points they count every
    user once per window.  The next bucket is looked up inside chunks of ``chunk_slides``
    buckets (the first n buckets of a chunk are also copied to the end of the one before), so
    neither a hot user nor a hot key is one task.  NULL users and NULL times count nowhere.
    Returns ``keys..., window_start, window_end, <out>``; ``size`` must be a multiple of ``slide``.
    """
    keys = _keys(keys)
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    if size_us <= 0 or slide_us <= 0 or size_us % slide_us:
        raise ValueError("window size must be a positive multiple of the slide")
    n = size_us // slide_us
    chunk = chunk_slides or max(8 * n, 4096)
    if chunk < n:
        raise ValueError("a chunk must be at least a window")
    seen = (df.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
            .select(*keys, F.col(user).alias("_u"), floor_div(epoch_us(df, ts), slide_us).alias("_b")).distinct())
    own = floor_div(F.col("_b"), chunk)
    head = F.col("_b") - own * chunk < n
    halo = seen.withColumn("_own", own).withColumn(
        "_c", F.explode(F.when(head, F.array(own, own - 1)).otherwise(F.array(own))))
    following = F.lead("_b").over(Window.partitionBy(*keys, "_u", "_c").orderBy("_b"))
    visits = (halo.withColumn("_to", F.least(F.col("_b") + n, following)).where(F.col("_c") == F.col("_own"))
              .groupBy(*keys, (F.col("_b") + 1).alias("_lo"), F.col("_to").alias("_hi")).agg(F.count(F.lit(1)).alias("_c")))
    ends = _sweep(visits, keys, chunk)
    return _with_bounds(ends, keys, size_us, slide_us, is_ntz(df, ts)).withColumn(out, F.col("_v").cast("long")) \
        .select(*keys, "window_start", "window_end", out)


def _with_bounds(ends: DataFrame, keys: list[str], size_us: int, slide_us: int, ntz: bool) -> DataFrame:
    end_us = F.col("_e") * F.lit(slide_us)
    return ends.withColumn("window_start", from_epoch_us(end_us - F.lit(size_us), ntz)) \
        .withColumn("window_end", from_epoch_us(end_us, ntz))


def window_top_n(df: DataFrame, ts: str, size, slide=None, keys: Sequence[str] | str = (), n: int = 3,
                 key: str | Sequence[str] | None = None, count_col: str = "cnt", rank_col: str = "rank",
                 chunk_slides: int | None = None) -> DataFrame:
    """Counts per (keys, window), then the ``n`` best keys of every window.

    The reference's hot-items / hot-URLs / hot-sales programs in one operator, with the
    rows of ``window_count`` followed by ``top_n``.  Counts only change at change points, so
    a chunk's time line is cut there into segments, each segment is ranked once, and only
    the kept rows are expanded into the segment's windows (:func:`_segment_ranks`).  With
    fewer than :data:`SEGMENTS_FROM` windows per event nearly every window is a segment of
    its own, and windows are ranked as they are.
    Returns ``keys..., window_start, window_end, <count_col>, <rank_col>``.
    """
    keys = _keys(keys)
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    tie = key if key is not None else keys
    if size_us % slide_us:
        return top_n(window_count(df, ts, size, slide, keys, count_col=count_col), n, by="window_end",
                     key=tie, count_col=count_col, rank_col=rank_col)
    ntz = is_ntz(df, ts)
    counts = bucketed(df, ts, slide_us, keys).groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    if size_us == slide_us:
        ends = counts.select(*keys, (F.col("_b") + 1).alias("_e"), F.col("_c").alias(count_col))
        ranked = top_n(ends, n, by="_e", key=tie, count_col=count_col, rank_col=rank_col)
    else:
        spread = _intervals(counts, size_us // slide_us)
        chunk = chunk_slides or max(8 * (size_us // slide_us), 4096)
        if size_us // slide_us < SEGMENTS_FROM:
            ends = _sweep(spread, keys, chunk).withColumnRenamed("_v", count_col)
            ranked = top_n(ends, n, by="_e", key=tie, count_col=count_col, rank_col=rank_col)
        else:
            ranked = _segment_ranks(spread, keys, chunk, n, _keys(tie), count_col, rank_col)
        ranked = ranked.withColumn(count_col, F.col(count_col).cast("long"))
    return _with_bounds(ranked, keys, size_us, slide_us, ntz).select(
        *keys, "window_start", "window_end", count_col, rank_col)


def _intervals(counts: DataFrame, n: int) -> DataFrame:
    """Bucket counts ``(keys, _b, _c)`` -> ``(keys, _lo, _hi, _c)``: bucket b is in the windows ending at b+1 .. b+n."""
    return counts.select("*", (F.col("_b") + 1).alias("_lo"), (F.col("_b") + n).alias("_hi")).drop("_b")


def _deltas(intervals: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """``(keys, _lo, _hi, _c)`` -> change points ``(keys, _k, e, d)`` per chunk ``_k`` of window ends.

    ``+c`` at an interval's first window end, or at the start of each later chunk it reaches;
    ``-c`` after its last one, unless that is in the next chunk.
    """
    lo, hi, c = F.col("_lo"), F.col("_hi"), F.col("_c")
    chunk_lo, chunk_hi = F.col("_k") * chunk, (F.col("_k") + 1) * chunk
    enter = F.struct(F.greatest(lo, chunk_lo).alias("e"), c.alias("d"))
    leave = F.struct((hi + 1).alias("e"), (-c).alias("d"))
    return (intervals
            .select(*keys, lo, hi, c, F.explode(F.sequence(floor_div(lo, chunk), floor_div(hi, chunk))).alias("_k"))
            .select(*keys, "_k", F.explode(F.when(hi + 1 < chunk_hi, F.array(enter, leave)).otherwise(F.array(enter))).alias("_x"))
            .select(*keys, "_k", F.col("_x.e").alias("e"), F.col("_x.d").alias("d")))


def _sweep(intervals: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """``(keys, _lo, _hi, _c)`` -> ``(keys, _e, _v)``: the sum of ``_c`` over the intervals that hold window end ``_e``."""
    w = Window.partitionBy(*keys, "_k").orderBy("e")
    runs = _deltas(intervals, keys, chunk).select(
        *keys, "_k", "e",
        F.sum("d").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("_run"),
        F.coalesce(F.lead("e").over(w), (F.col("_k") + 1) * chunk).alias("_stop"),
    )
    return (runs.where((F.col("_run") > 0) & (F.col("_stop") > F.col("e")))
            .select(*keys, F.explode(F.sequence(F.col("e"), F.col("_stop") - 1)).alias("_e"),
                    F.col("_run").alias("_v")))


def _segment_ranks(intervals: DataFrame, keys: list[str], chunk: int, n: int, tie: list[str], count_col: str,
                   rank_col: str) -> DataFrame:
    """``(keys, _e, count, rank)``: the ``n`` best keys of every window end, ranked once per segment.

    The distinct change points of a chunk, over all keys, cut it into segments (at most one
    per window end; numbered from a small table of points).  Inside a segment no count
    changes.  A key's run from one of its change points to its next covers whole segments:
    it is copied into those, ranked there, and a kept row is copied into the segment's windows.
    """
    deltas = _deltas(intervals, keys, chunk)
    by_chunk = Window.partitionBy("_k").orderBy("e")
    base = F.col("_k") * (chunk + 1)  # a chunk has at most `chunk` segments: one number for chunk and segment
    points = deltas.select("_k", "e").distinct().select(
        "e", (base + F.row_number().over(by_chunk)).alias("_s"),
        F.coalesce(F.lead("e").over(by_chunk), (F.col("_k") + 1) * chunk).alias("_next"),
        (base + F.count(F.lit(1)).over(Window.partitionBy("_k")) + 1).alias("_end"))
    w = Window.partitionBy(*keys, "_k").orderBy("e")
    # a shuffled join, also where a broadcast would fit: a chunk's keys must not meet in one task
    runs = (deltas.join(points.select("e", "_s", "_end").hint("shuffle_hash"), "e")
            .select(*keys, "_s",
                    F.sum("d").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias(count_col),
                    F.coalesce(F.lead("_s").over(w), F.col("_end")).alias("_stop"))
            .where((F.col(count_col) > 0) & (F.col("_stop") > F.col("_s"))))
    parts = runs.select(*keys, F.explode(F.sequence(F.col("_s"), F.col("_stop") - 1)).alias("_s"),
                        F.col(count_col).cast("long").alias(count_col))
    ranked = top_n(parts, n, by="_s", key=tie, count_col=count_col, rank_col=rank_col)
    return (ranked.join(points.select("_s", "e", "_next"), "_s")
            .select(*keys, F.explode(F.sequence(F.col("e"), F.col("_next") - 1)).alias("_e"), count_col, rank_col))


def _window_plan(df: DataFrame, ts: str, size_us: int, slide_us: int, keys: list[str],
                 count_col: str) -> DataFrame:
    win = F.window(_time(df, ts), f"{size_us} microseconds", f"{slide_us} microseconds")
    return (df.where(F.col(ts).isNotNull()).groupBy(*keys, win.alias("_w")).agg(F.count(F.lit(1)).alias(count_col))
            .select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                    F.col(count_col).cast("long").alias(count_col)))


def top_n(df: DataFrame, n: int, by: str | Sequence[str] = "window_end",
          order: Sequence[Column] | None = None, key: str | Sequence[str] | None = None,
          count_col: str = "cnt", rank_col: str = "rank") -> DataFrame:
    """Keep the ``n`` best rows per ``by`` group, numbered 1..n in ``rank_col``.

    Default order: ``count_col`` descending, then ``key`` ascending (the
    reference's stable sort keeps arrival order for ties, which is not defined
    for window results, so ties are broken by key).  Written as
    ``row_number() <= n`` so Catalyst inserts a partial ``WindowGroupLimit``
    before the shuffle: each map task forwards at most ``n`` rows per group.
    """
    by = _keys(by)
    if order is None:
        order = [F.col(count_col).desc()] + [F.col(k).asc() for k in _keys(key)]
    w = Window.partitionBy(*by).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    return ranked.where(F.col(rank_col) <= n).withColumn(rank_col, F.col(rank_col).cast("long"))


def _time(df: DataFrame, ts: str) -> Column:
    """``ts`` as a timestamp (long epoch seconds are turned into one)."""
    return F.col(ts) if ts_is_timestamp(df, ts) else from_epoch_us(epoch_us(df, ts), False)


def _plus(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


#: Measures that merge over slide buckets: partial aggregates of a bucket, each with the
#: aggregate and the two-argument function that combine it, and the result from the parts.
_MERGE = {
    "sum": (lambda c: [(F.sum(c), F.sum, _plus)], lambda p: p[0]),
    "count": (lambda c: [(F.count(c), F.sum, _plus)], lambda p: p[0]),
    "min": (lambda c: [(F.min(c), F.min, F.least)], lambda p: p[0]),
    "max": (lambda c: [(F.max(c), F.max, F.greatest)], lambda p: p[0]),
    "avg": (lambda c: [(F.sum(c), F.sum, _plus), (F.count(c), F.sum, _plus)], lambda p: p[0] / F.when(p[1] > 0, p[1])),
}


def window_measures(df: DataFrame, ts: str, size, slide=None, keys: Sequence[str] | str = (),
                    measures: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Sums, counts, minima, maxima and averages per (keys, window), through slide buckets.

    ``measures`` maps output names to ``(kind, column)``: ``{"amount": ("sum",
    "value")}`` with kind ``sum``, ``count``, ``min``, ``max`` or ``avg``.  Events
    are aggregated per (keys, slide bucket) first (partial aggregation before the
    shuffle).  ``size`` must be a multiple of ``slide``.
    Returns ``keys..., window_start, window_end, <measures>``.

    Buckets are cut into blocks of ``size / slide``.  The window ends of a block see the
    start of that block and the end of the one before, so a window is a growing aggregate
    going on in time combined with one going back: a bucket is copied once, whatever the
    number of its windows, and nothing is subtracted (a NaN leaves with its bucket).  The
    value only changes where a bucket enters or leaves; each constant run is expanded into
    its windows at the end.  A task holds two blocks of one key at a time.
    """
    keys = _keys(keys)
    if not measures or any(kind not in _MERGE for kind, _ in measures.values()):
        raise ValueError(f"give measures of kind {sorted(_MERGE)}")
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    if size_us <= 0 or slide_us <= 0 or size_us % slide_us:
        raise ValueError("window size must be a positive multiple of the slide")
    n = size_us // slide_us
    rows = df.where(F.col(ts).isNotNull()).withColumn("_b", floor_div(epoch_us(df, ts), slide_us))
    parts = {name: [(f"_{name}_{i}", *x) for i, x in enumerate(_MERGE[kind][0](F.col(col)))]
             for name, (kind, col) in measures.items()}
    flat = [("_any", F.count(F.lit(1)), F.sum, _plus)] + [x for own in parts.values() for x in own]
    buckets = rows.groupBy(*keys, "_b").agg(*[c.alias(a) for a, c, _, _ in flat])
    block, b = floor_div(F.col("_b"), n), F.col("_b")
    side = lambda p, pos, new: buckets.select(
        *keys, p.alias("_p"), pos.alias("_pos"), F.lit(new).alias("_new"), *[a for a, *_ in flat])
    both = side(block, b + 1, True).unionByName(side(block + 1, b + n + 1, False))  # enters; leaves
    part = Window.partitionBy(*keys, "_p")
    asc, back = part.orderBy("_pos"), part.orderBy(F.col("_pos").desc())
    up_to = asc.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = back.rangeBetween(Window.unboundedPreceding, -1)
    whole = back.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    new = lambda a: F.when(F.col("_new"), F.col(a))
    old = lambda a: F.when(~F.col("_new"), F.col(a))
    runs = both.select(
        *keys, "_p", "_pos", F.lag("_pos").over(asc).alias("_prev"), F.lead("_pos").over(asc).alias("_following"),
        *[x for a, _, agg, _ in flat for x in (agg(new(a)).over(up_to).alias(f"{a}_new"), agg(old(a)).over(after).alias(f"{a}_old"),
                                               agg(old(a)).over(whole).alias(f"{a}_all"))])
    here = F.struct(F.col("_pos").alias("lo"), F.coalesce(F.col("_following") - 1, (F.col("_p") + 1) * n).alias("hi"),
                    *[two(F.col(f"{a}_new"), F.col(f"{a}_old")).alias(a) for a, _, _, two in flat])
    # before the block's first change only the block before counts, with all its buckets
    before = F.struct((F.col("_p") * n + 1).alias("lo"), (F.col("_pos") - 1).alias("hi"), *[F.col(f"{a}_all").alias(a) for a, *_ in flat])
    runs = (runs.select(*keys, F.explode(F.when(F.col("_prev").isNull(), F.array(before, here)).otherwise(F.array(here))).alias("_r"))
            .where((F.col("_r.lo") <= F.col("_r.hi")) & (F.col("_r._any") > 0)))
    ends = runs.select(*keys, F.explode(F.sequence(F.col("_r.lo"), F.col("_r.hi"))).alias("_e"), *[
        _MERGE[kind][1]([F.col("_r")[a] for a, *_ in parts[name]]).alias(name) for name, (kind, _) in measures.items()])
    return _with_bounds(ends, keys, size_us, slide_us, is_ntz(df, ts)).select(
        *keys, "window_start", "window_end", *measures)


def window_agg(df: DataFrame, ts: str, size, slide=None, keys: Sequence[str] | str = (),
               aggs: dict[str, Column] | None = None) -> DataFrame:
    """Any built-in aggregates per (keys, window): the user-aggregate extension point.

    For aggregates that do not merge from buckets (distinct counts, percentiles); sums,
    counts, minima, maxima and averages go through :func:`window_measures`, which does
    not copy events.

    ``aggs`` maps output names to aggregate Columns (``{"amount": F.sum("value"),
    "users": F.count_distinct("user_id")}``).  Rows are assigned to their
    windows by ``F.window`` (``size / slide`` copies per row) and aggregated
    with partial aggregation (JVM-side, no Python); for plain counts use
    :func:`window_count`, whose sweep avoids the copies.
    Returns ``keys..., window_start, window_end, <aggs>``.
    """
    keys = _keys(keys)
    if not aggs:
        raise ValueError("give at least one aggregate")
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    win = F.window(_time(df, ts), f"{size_us} microseconds", f"{slide_us} microseconds")
    out = df.where(F.col(ts).isNotNull()).groupBy(*keys, win.alias("_w")).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      *aggs.keys())
