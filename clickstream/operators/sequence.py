"""Sequence (pattern) detection over per-key event order.

Semantics follow the reference's pattern programs: events are ordered per key by
``(ts, seq)``; ``within`` means ``last.ts - first.ts < within`` (strict); with
the default no-skip strategy every event may start a match, so matches overlap;
with skip-past-last-event, a completed match discards every partial match that
started at or before its last event, and when several complete on the same
event the earliest start wins.

Three tiers, one plan shape:

1. **Window functions** - fixed-length runs (``consecutive``, ``n_in_span``):
   ``lead`` over the key's timeline.
2. **Candidates + greedy selection** - non-overlapping blocks (``blocks``,
   ``threshold_then_next``, ``burst``): every possible match is an interval
   ``[start, end]`` found by window functions; :func:`greedy_select` keeps the
   ones the skip strategy keeps.
3. **Conditions on captured events** (``follow_distinct``: the multi-account
   rules): counting window functions give the row number at which a start's
   match completes, an equi-join fetches that row, then the same greedy selection.

Scaling: all per-event work runs over **time chunks with a halo**.  A key's
timeline is cut into chunks of ``chunk`` length; rows in the first ``within`` of
a chunk are also copied into the previous chunk (flagged as halo).  A match is
shorter than ``within``, so a match starting in a chunk sees all its events in
that chunk's partition, and a hot key (one user with a third of all rows) is
spread over ``time range / chunk`` tasks instead of one.  Halo rows never start
a match.  Only the candidate intervals reach the greedy selection.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from clickstream.functions.eventtime import duration_us, epoch_us
from clickstream.session import materialize
from clickstream.operators.sorted_groups import group_starts, scan_sorted_groups
from clickstream.operators.windows import floor_div

#: Shortest automatic chunk: a hot key is cut at least every hour.
MIN_CHUNK_US = 3_600_000_000


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _chunk_us(span_us: int, chunk=None) -> int:
    if chunk is not None:
        c = duration_us(chunk)
        if c < span_us:
            raise ValueError("chunk must be at least the pattern span")
        return c
    return max(8 * span_us, MIN_CHUNK_US)


def with_halo(df: DataFrame, us: str, span_us: int, chunk_us: int) -> DataFrame:
    """Add ``_own`` (the row's chunk) and ``_chunk`` (the partition it is in).

    Rows less than ``span_us`` after their chunk start appear twice: in their own
    chunk and, as halo (``_chunk != _own``), at the end of the previous one.
    """
    own = floor_div(F.col(us), chunk_us)
    head = F.col(us) - own * F.lit(chunk_us) < F.lit(span_us)
    return (df.withColumn("_own", own)
            .withColumn("_chunk", F.explode(F.when(head, F.array(own, own - 1)).otherwise(F.array(own)))))


def _base(df: DataFrame, keys, ts, seq, extra: Sequence[Column] = ()) -> DataFrame:
    return df.select(*keys, F.col(ts).alias("_ts"), F.col(seq).alias("_seq"),
                     epoch_us(df, ts).alias("_us"), *extra)


def _pos(us="_us", seq="_seq", ts="_ts") -> Column:
    """A comparable event position: (epoch us, seq), carrying the timestamp."""
    return F.struct(F.col(us).alias("us"), F.col(seq).alias("seq"), F.col(ts).alias("ts"))


# --------------------------------------------------------------------------- tier 1

def _run_candidates(df, keys, ts, seq, n, within, cond, contiguous, chunk):
    keys = _keys(keys)
    span = duration_us(within)
    ok = F.lit(True) if cond is None else cond
    base = _base(df, keys, ts, seq, [ok.alias("_ok")])
    if not contiguous:
        base = base.where(F.col("_ok"))  # relaxed contiguity: non-matching events are skipped
    h = with_halo(base, "_us", span, _chunk_us(span, chunk))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_us", "_seq")
    all_ok = F.col("_ok")
    for i in range(1, n):
        all_ok = all_ok & F.coalesce(F.lead("_ok", i).over(w), F.lit(False))
    last_us = F.lead("_us", n - 1).over(w)
    cand = h.select(*keys, "_chunk", "_own", "_ts", "_us", "_seq",
                    all_ok.alias("_all"), (last_us - F.col("_us")).alias("_dt"),
                    F.lead(_pos(), n - 1).over(w).alias("_endpos"))
    return keys, (cand.where((F.col("_chunk") == F.col("_own")) & F.col("_all")
                             & (F.col("_dt") < F.lit(span)))
                  .select(*keys, _pos().alias("_startpos"), "_endpos"))


def consecutive(df: DataFrame, keys, ts: str, seq: str, cond: Column, within, n: int = 2,
                chunk=None) -> DataFrame:
    """``n`` strictly adjacent events all meeting ``cond`` within the span (every start).

    The reference's two-failures rules: the hand-written detector (fail after a
    stored fail, ``|dt| < 5 s``) and ``fail next fail within 5 s``.
    Returns ``keys..., first_ts, last_ts``.
    """
    keys, c = _run_candidates(df, keys, ts, seq, n, within, cond, True, chunk)
    return c.select(*keys, F.col("_startpos.ts").alias("first_ts"), F.col("_endpos.ts").alias("last_ts"))


def n_in_span(df: DataFrame, keys, ts: str, seq: str, n: int, within, cond: Column | None = None,
              chunk=None) -> DataFrame:
    """Every run of ``n`` events meeting ``cond`` (others skipped) within the span.

    The reference's "any event, three times, within 5 s" rule (overlapping).
    Returns ``keys..., first_ts, last_ts``.
    """
    keys, c = _run_candidates(df, keys, ts, seq, n, within, cond, False, chunk)
    return c.select(*keys, F.col("_startpos.ts").alias("first_ts"), F.col("_endpos.ts").alias("last_ts"))


# --------------------------------------------------------------------------- greedy selection

_NONE = np.iinfo(np.int64).min


def _ranks(su, sq, eu, eq) -> tuple[np.ndarray, np.ndarray]:
    """Dense comparable ranks of the start and end positions (us, seq) of a group."""
    us, seq = np.concatenate((su, eu)), np.concatenate((sq, eq))
    order = np.lexsort((seq, us))
    new = np.ones(len(us), bool)
    new[1:] = (us[order][1:] != us[order][:-1]) | (seq[order][1:] != seq[order][:-1])
    rank = np.empty(len(us), np.int64)
    rank[order] = np.cumsum(new)
    return rank[:len(su)], rank[len(su):]


def _exits(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(last, sorted starts, first)`` for intervals in (end, start) order.

    The interval taken after an end ``x`` is the first in order that starts after
    ``x``: ``first[searchsorted(sorted starts, x, "right")]`` (``n`` when there is
    none).  It does not depend on how ``x`` was reached, so ``last[i]``, the last
    interval taken once ``i`` is, follows in one walk from the back.
    """
    n = len(start)
    by_start = np.argsort(start, kind="stable")
    starts = start[by_start]
    first = np.minimum.accumulate(np.append(by_start, n)[::-1])[::-1]
    after = first[np.searchsorted(starts, end, side="right")].tolist()
    last = list(range(n + 1))
    for i in range(n - 1, -1, -1):
        if after[i] < n:
            last[i] = last[after[i]]
    return np.array(last), starts, first


def _variant_exits(table: pa.Table, chunk_us: int) -> pa.Table:
    """Pass 1 over (key, chunk) groups: each chunk's exit state for every entry state.

    Only intervals that started before the chunk start ("straddlers") can be
    blocked by an earlier choice, and an entry state blocks exactly the
    straddlers starting at or before it: variant ``p`` blocks the first ``p``
    distinct straddler starts.  Emits runs ``[p_lo, p_hi] -> exit``.  Rows arrive
    sorted by (key, chunk, end, start); the work is n log n.
    """
    su, sq, eu, eq, gc = (table[c].to_numpy() for c in ("s_us", "s_seq", "e_us", "e_seq", "_gc"))
    bounds = group_starts(table, ["_gk", "_gc"]).tolist() + [table.num_rows]
    at, lo, hi, xu, xq = [], [], [], [], []
    for a, b in zip(bounds[:-1], bounds[1:]):
        start, end = _ranks(su[a:b], sq[a:b], eu[a:b], eq[a:b])
        last, starts, first = _exits(start, end)
        blocked = np.unique(start[su[a:b] < gc[a] * chunk_us])
        taken = first[np.searchsorted(starts, np.concatenate(([-1], blocked)), side="right")]
        exits = np.where(taken < b - a, last[taken], -1)
        cut = np.flatnonzero(np.concatenate(([True], exits[1:] != exits[:-1])))
        stop = np.append(cut[1:], len(exits)) - 1
        x = exits[cut]
        at += [a] * len(cut)
        lo += cut.tolist()
        hi += stop.tolist()
        xu += np.where(x < 0, _NONE, eu[a:b][x]).tolist()
        xq += np.where(x < 0, _NONE, eq[a:b][x]).tolist()
    out = table.select(["_gk", "_gc"]).take(pa.array(at, pa.int64()))
    for name, col in (("p_lo", lo), ("p_hi", hi), ("x_us", xu), ("x_seq", xq)):
        out = out.append_column(name, pa.array(col, pa.int64()))
    return out


def _items(table: pa.Table, group: list[str]):
    """Per group ``(first row, items)``; an item is ``(row, end row, variant starts, exits, exit before -> variant)``.

    Rows are ``kind = 0``: variant range -> exit, and ``kind = 1``: an exit of the item before
    -> the variant it selects, sorted by (group, item, kind, variant).
    """
    at, kind, plo, xu, xq = (table[c].to_pylist() for c in ("_at", "kind", "p_lo", "x_us", "x_seq"))
    bounds = group_starts(table, group).tolist() + [table.num_rows]
    for a, b in zip(bounds[:-1], bounds[1:]):
        items, i = [], a
        while i < b:
            j, starts, exits, chosen = i, [], [], {}
            while j < b and at[j] == at[i]:
                x = None if xu[j] == _NONE else (xu[j], xq[j])
                if kind[j] == 0:
                    starts.append(plo[j])
                    exits.append(x)
                else:
                    chosen[x] = plo[j]
                j += 1
            items.append((i, j, starts, exits, chosen))
            i = j
        yield a, items


def _exit(item: tuple, entry: tuple | None) -> tuple | None:
    """An item's exit after the exit ``entry`` of the item before; without one nothing is blocked (variant 0)."""
    _, _, starts, exits, chosen = item
    return exits[bisect_right(starts, chosen.get(entry, 0)) - 1]


def _compose(table: pa.Table) -> pa.Table:
    """One item for each block of neighbours: variants of its first item -> exit of its last.

    All exits still possible go through the block together; those that meet stay together.
    """
    kind, xu, xq = (table[c].to_pylist() for c in ("kind", "x_us", "x_seq"))
    at, us, seq = [], [], []
    for _, items in _items(table, ["_gk", "_run", "_block"]):
        row, stop, _, exits, _ = items[0]
        end = {x: x for x in exits}
        for item in items[1:]:
            step = {x: _exit(item, x) for x in set(end.values())}
            end = {x: step[y] for x, y in end.items()}
        for r in range(row, stop):  # the first item's variants with the block's exits, and what selects them
            x = (xu[r], xq[r]) if kind[r] else end[exits[r - row]] or (_NONE, _NONE)
            at.append(r)
            us.append(int(x[0]))
            seq.append(int(x[1]))
    out = table.select(["_gk", "_run", "_block", "kind", "p_lo", "p_hi"]).take(pa.array(at, pa.int64()))
    out = out.rename_columns(["_gk", "_run", "_at", "kind", "p_lo", "p_hi"])
    return out.append_column("x_us", pa.array(us, pa.int64())).append_column("x_seq", pa.array(seq, pa.int64()))


def _chain(table: pa.Table, group: list[str]) -> pa.Table:
    """Walk the items of a group in order and fix each one's true entry, from the group's own (``in_us``, ``in_seq``)."""
    at, us, seq = [], [], []
    first = [table[c].to_pylist() for c in ("in_us", "in_seq")]
    for a, items in _items(table, group):
        entry = None if first[0][a] == _NONE else (first[0][a], first[1][a])
        for item in items:
            at.append(item[0])
            us.append(_NONE if entry is None else entry[0])
            seq.append(_NONE if entry is None else entry[1])
            entry = _exit(item, entry)
    out = table.select(["_gk", "_run", "_at"]).take(pa.array(at, pa.int64()))
    for name, col in (("in_us", us), ("in_seq", seq)):
        out = out.append_column(name, pa.array(col, pa.int64()))
    return out


def _entries(items: DataFrame, longest: int, fan: int) -> DataFrame:
    """``(_gk, _run, _at, in_us, in_seq)``: the entry of every item, composed in blocks of ``fan``, level by level.

    Up: blocks of neighbours become items of the next level, until a run has at most ``fan``.  Down: the entry of
    a block goes through its items.  A task holds ``fan`` items of a run at a time, however long the run is.
    """
    longs = lambda *names: [T.StructField(n, T.LongType()) for n in names]
    key = [T.StructField("_gk", T.StringType())]
    found = T.StructType(key + longs("_run", "_at", "in_us", "in_seq"))
    shape = T.StructType(key + longs("_run", "_at", "kind", "p_lo", "p_hi", "x_us", "x_seq"))
    block, order = ["_gk", "_run", "_block"], ["_at", "kind", "p_lo"]
    levels = []
    while longest > fan:
        items = materialize(items, "greedy-level").withColumn("_block", floor_div(F.col("_at"), fan))
        levels.append(items)
        items = scan_sorted_groups(items, block, order, _compose, shape)
        longest = -(-longest // fan)
    none = F.lit(int(_NONE))
    out = scan_sorted_groups(items.withColumn("in_us", none).withColumn("in_seq", none), ["_gk", "_run"], order,
                             lambda t: _chain(t, ["_gk", "_run"]), found)
    for items in reversed(levels):
        own = items.join(out.withColumnRenamed("_at", "_block"), block)
        out = scan_sorted_groups(own, block, order, lambda t: _chain(t, block), found)
    return out


def _final_greedy(table: pa.Table) -> pa.Table:
    """Pass 3 over (key, chunk) groups: the greedy choice from the known entry state."""
    su, sq, eu, eq, iu, iq = (table[c].to_pylist() for c in ("s_us", "s_seq", "e_us", "e_seq", "in_us", "in_seq"))
    keep = [False] * table.num_rows
    bounds = group_starts(table, ["_gk", "_gc"]).tolist() + [table.num_rows]
    for a, b in zip(bounds[:-1], bounds[1:]):
        last = (iu[a], iq[a])  # _NONE is before every position
        for i in range(a, b):
            if (su[i], sq[i]) > last:
                keep[i] = True
                last = (eu[i], eq[i])
    return table.filter(pa.array(keep, pa.bool_()))


def greedy_select(iv: DataFrame, keys, span_us: int, chunk=None, fan: int = 256) -> DataFrame:
    """Keep the intervals the skip-past-last-event strategy keeps.

    ``iv`` has ``keys`` plus flat ``s_us, s_seq, e_us, e_seq`` (start and end
    positions; one interval per start; ``e_us - s_us <= span_us``) and any
    payload.  Per key (NULL is a key like any other), in ``(end, start)`` order,
    an interval is taken when it starts after the last taken end.

    Distributed in three steps so no task holds more than one time chunk of a
    key: (1) per (key, chunk of ends), the exit state for every entry state;
    (2) per key and run of chunks that intervals tie together, the chunks' maps
    are composed in blocks of ``fan`` neighbours (:func:`_entries`), which fixes
    each chunk's entry; (3) per (key, chunk), the choice from that entry.
    """
    keys = _keys(keys)
    chunk_us = _chunk_us(span_us, chunk)
    if fan < 2:
        raise ValueError("fan must be at least 2")
    # one text key that is never NULL: groups and joins treat NULL keys like others
    key = F.to_json(F.struct(*keys)) if keys else F.lit("")
    base = iv.withColumn("_gc", floor_div(F.col("e_us"), chunk_us)).withColumn("_gk", key)
    # the candidates feed three passes: write them once to the shared checkpoint
    # folder (lineage cut, nothing recomputed after an executor loss)
    base = materialize(base, "greedy-candidates")
    group = ["_gk", "_gc"]
    order = ["e_us", "e_seq", "s_us", "s_seq"]
    longs = lambda *names: [T.StructField(n, T.LongType()) for n in names]
    kfields = [T.StructField("_gk", T.StringType()), T.StructField("_gc", T.LongType())]

    slim = base.select(*group, F.col("s_us").cast("long"), F.col("s_seq").cast("long"), F.col("e_us").cast("long"),
                       F.col("e_seq").cast("long"))
    runs = materialize(scan_sorted_groups(slim, group, order, lambda t: _variant_exits(t, chunk_us),
                                          T.StructType(kfields + longs("p_lo", "p_hi", "x_us", "x_seq"))),
                       "greedy-runs")  # read twice

    # variant chosen in chunk j by each exit of chunk j-1: straddler starts at or before it
    strad = slim.where(F.col("s_us") < F.col("_gc") * F.lit(chunk_us)).select(
        *group, F.col("s_us").alias("pu"), F.col("s_seq").alias("pq"), F.lit(0).alias("tag"))
    exits = runs.where(F.col("x_us") != F.lit(int(_NONE))).select(
        "_gk", (F.col("_gc") + 1).alias("_gc"), F.col("x_us").alias("pu"), F.col("x_seq").alias("pq"),
        F.lit(1).alias("tag")).dropDuplicates()
    order_w = Window.partitionBy(*group).orderBy("pu", "pq", "tag")
    w = order_w.rowsBetween(Window.unboundedPreceding, 0)
    # count distinct straddler starts (variants are defined over distinct start positions)
    new_pos = ((F.col("tag") == 0) & F.coalesce((F.lag("pu").over(order_w) != F.col("pu"))
                                                | (F.lag("pq").over(order_w) != F.col("pq")), F.lit(True)))
    pmap = (strad.unionByName(exits).withColumn("_new", new_pos.cast("int"))
            .withColumn("p", F.sum("_new").over(w))
            .where(F.col("tag") == 1)
            .select(*group, F.lit(1).alias("kind"), F.col("p").cast("long").alias("p_lo"),
                    F.lit(int(_NONE)).alias("p_hi"), F.col("pu").alias("x_us"), F.col("pq").alias("x_seq")))

    # runs of chunks, named by their first: a chunk without straddlers (one variant) starts a new one; one row per chunk here
    chunks = runs.groupBy(*group).agg(F.max("p_hi").alias("top"))
    by_key = Window.partitionBy("_gk").orderBy("_gc")
    cut = (F.col("top") == 0) | F.coalesce(F.lag("_gc").over(by_key) != F.col("_gc") - 1, F.lit(True))
    chunks = (chunks.withColumn("first", F.when(cut, F.col("_gc")))
              .select(*group, F.max("first").over(by_key.rowsBetween(Window.unboundedPreceding, 0)).alias("_run")))
    longest = chunks.agg(F.max(F.col("_gc") - F.col("_run") + 1)).first()[0] or 0
    summary = (runs.select(*group, F.lit(0).cast("long").alias("kind"), "p_lo", "p_hi", "x_us", "x_seq")
               .unionByName(pmap.withColumn("kind", F.col("kind").cast("long"))).join(chunks, group)
               .select("_gk", "_run", (F.col("_gc") - F.col("_run")).alias("_at"), "kind", "p_lo", "p_hi", "x_us", "x_seq"))
    entries = _entries(summary, longest, fan).select(
        "_gk", (F.col("_run") + F.col("_at")).alias("_gc"), "in_us", "in_seq")

    joined = base.join(entries, group, "left").fillna(int(_NONE), ["in_us", "in_seq"]).select(
        *base.columns, "in_us", "in_seq")
    chosen = scan_sorted_groups(joined, group, order, _final_greedy, joined.schema)
    return chosen.drop("_gc", "_gk", "in_us", "in_seq")


def _flat(prefix: str, pos: Column) -> list[Column]:
    return [pos["us"].alias(f"{prefix}_us"), pos["seq"].alias(f"{prefix}_seq"), pos["ts"].alias(f"{prefix}_ts")]


# --------------------------------------------------------------------------- tier 2

def blocks(df: DataFrame, keys, ts: str, seq: str, n: int, within, cond: Column | None = None,
           chunk=None) -> DataFrame:
    """Non-overlapping blocks of exactly ``n`` events within the span.

    The reference's "six or more within 11 min, skip past last event": a match is
    emitted at its ``n``-th event and every longer continuation is pruned, so the
    result is greedy blocks of exactly ``n``.  Returns ``keys..., first_ts, last_ts``.
    """
    keys, c = _run_candidates(df, keys, ts, seq, n, within, cond, False, chunk)
    flat = c.select(*keys, *_flat("s", F.col("_startpos")), *_flat("e", F.col("_endpos")))
    return greedy_select(flat, keys, duration_us(within), chunk).select(
        *keys, F.col("s_ts").alias("first_ts"), F.col("e_ts").alias("last_ts"))


def trailing_sum(df: DataFrame, keys, ts: str, seq: str, value: str, span, out: str = "trailing",
                 chunk=None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the key's rows in ``(ts - span, ts]``.

    The column's own arithmetic is kept: integers and decimals add exactly, doubles as
    doubles (a NaN or an infinity is in the sums of its span and no longer), NULL adds
    nothing.

    Time is cut into blocks as long as the span, so ``(ts - span, ts]`` is the start of the
    row's own block and the end of the block before: two growing sums, one going on in time
    and one going back, added.  Nothing is subtracted, a row is copied once, and a hot key
    is spread over its blocks (``chunk`` is accepted as elsewhere, but not needed).
    """
    keys = _keys(keys)
    span_us = duration_us(span)
    us = epoch_us(df, ts)
    block = floor_div(us, span_us)
    zero = F.lit(0)
    rows = df.select(F.struct("*").alias("_row"), *keys, block.alias("_block"), us.alias("_pos"),
                     F.col(value).alias("_new"), F.lit(None).cast(df.schema[value].dataType).alias("_old"))
    # a row of the block before counts until its time plus the span
    left = df.select(*keys, (block + 1).alias("_block"), (us + F.lit(span_us)).alias("_pos"), F.col(value).alias("_old"))
    both = rows.unionByName(left, allowMissingColumns=True)
    part = Window.partitionBy(*keys, "_block")
    up_to = part.orderBy("_pos").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    still = part.orderBy(F.col("_pos").desc()).rangeBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("_new").over(up_to), zero) + F.coalesce(F.sum("_old").over(still), zero)
    out_type = df.select(F.sum(value).alias("x")).schema["x"].dataType
    return (both.withColumn("_sum", total.cast(out_type)).where(F.col("_row").isNotNull())
            .select(*[F.col(f"_row.`{c}`") for c in df.columns], F.col("_sum").alias(out)))


def threshold_then_next(df: DataFrame, keys, ts: str, seq: str, value: str, threshold: float,
                        within, chunk=None, mode: str = "strict") -> DataFrame:
    """An event with ``value > threshold`` immediately followed by any event, within the span.

    ``mode="strict"`` (the reference's behaviour): the rule sums the points of
    the single start event only.  ``mode="cumulative"`` (its evident intent):
    the start qualifies when the key's points in ``(ts - within, ts]`` sum to
    more than ``threshold``.  Matches do not overlap (skip past last event).
    Returns ``keys..., first_ts, next_ts``.
    """
    keys = _keys(keys)
    span = duration_us(within)
    if mode == "cumulative":
        df = trailing_sum(df, keys, ts, seq, value, within, out="_points", chunk=chunk)
        value = "_points"
    elif mode != "strict":
        raise ValueError("mode must be 'strict' or 'cumulative'")
    base = _base(df, keys, ts, seq, [(F.col(value) > F.lit(threshold)).alias("_hot")])
    h = with_halo(base, "_us", span, _chunk_us(span, chunk))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_us", "_seq")
    c = (h.select(*keys, "_chunk", "_own", "_hot", "_us", _pos().alias("_startpos"),
                  (F.lead("_us").over(w) - F.col("_us")).alias("_dt"), F.lead(_pos()).over(w).alias("_endpos"))
         .where((F.col("_chunk") == F.col("_own")) & F.col("_hot") & (F.col("_dt") < F.lit(span)))
         .select(*keys, *_flat("s", F.col("_startpos")), *_flat("e", F.col("_endpos"))))
    return greedy_select(c, keys, span, chunk).select(*keys, F.col("s_ts").alias("first_ts"),
                                                      F.col("e_ts").alias("next_ts"))


def burst(df: DataFrame, keys, ts: str, seq: str, is_fail: Column, min_count: int, span,
          chunk=None) -> DataFrame:
    """Bursts of failures inside a run of failures (the timer-based detector).

    Within a run of fails unbroken by a non-fail, a group opens at the first
    ungrouped fail ``f`` and holds the run's fails with ``ts <= f.ts + span``;
    the next group opens at the next fail.  Groups of at least ``min_count``
    are returned as ``keys..., first_ts, last_ts, times``.
    """
    keys = _keys(keys)
    span_us = duration_us(span)
    base = _base(df, keys, ts, seq, [F.coalesce(is_fail, F.lit(False)).alias("_fail")])  # an unknown type is no failure
    h = with_halo(base, "_us", span_us + 1, _chunk_us(span_us + 1, chunk))
    part = Window.partitionBy(*keys, "_chunk")
    asc = part.orderBy("_us", "_seq")
    desc_run = part.orderBy(F.col("_us").desc(), F.col("_seq").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # row numbers rise with time, so the last row of [us, us + span] is the last up to us + span
    ahead = part.orderBy("_us").rangeBetween(Window.unboundedPreceding, span_us)
    x = (h.withColumn("_rn", F.row_number().over(asc))
         .withColumn("_prev", F.lag(_pos()).over(asc)))
    nonfail = ~F.col("_fail")
    x = x.select(
        *keys, "_chunk", "_own", "_fail", "_rn", _pos().alias("_startpos"),
        # nearest following non-fail (its row number, and the position just before it)
        F.last(F.when(nonfail, F.col("_rn")), ignorenulls=True).over(desc_run).alias("_nf_rn"),
        F.last(F.when(nonfail, F.col("_prev")), ignorenulls=True).over(desc_run).alias("_nf_prev"),
        # last event within the span
        F.max("_rn").over(ahead).alias("_span_rn"),
        F.max(_pos()).over(ahead).alias("_span_pos"),
    )
    cut = F.col("_nf_rn").isNotNull() & (F.col("_nf_rn") - 1 < F.col("_span_rn"))
    iv = (x.where((F.col("_chunk") == F.col("_own")) & F.col("_fail"))
          .select(*keys, *_flat("s", F.col("_startpos")),
                  *_flat("e", F.when(cut, F.col("_nf_prev")).otherwise(F.col("_span_pos"))),
                  (F.when(cut, F.col("_nf_rn") - 1).otherwise(F.col("_span_rn")) - F.col("_rn") + 1)
                  .alias("times")))
    groups = greedy_select(iv, keys, span_us + 1, chunk)
    return groups.where(F.col("times") >= min_count).select(
        *keys, F.col("s_ts").alias("first_ts"), F.col("e_ts").alias("last_ts"),
        F.col("times").cast("long").alias("times"))


# --------------------------------------------------------------------------- tier 3

def follow_distinct(df: DataFrame, key: str | None, ts: str, seq: str, who: str, n_more: int, within,
                    chain: bool = False, cond: Column | None = None, chunk=None) -> DataFrame:
    """Start event followed by ``n_more`` events whose ``who`` differs, within the span.

    ``chain=False``: each later event's ``who`` differs from the start's (the
    reference's multi-account rule).  ``chain=True``: each differs from the
    previously captured one (the account-chain rule).  Events not meeting
    ``cond`` are skipped (followed-by contiguity); skip past last event.
    ``key=None`` runs keyless (the reference's form), still split by time chunks.
    Returns ``key, start_<who>, first_ts, last_ts``.
    """
    span = duration_us(within)
    src = df if cond is None else df.where(cond)
    key_col = F.col(key) if key else F.lit(0)
    base = src.select(key_col.alias("_key"), F.col(ts).alias("_ts"), F.col(seq).cast("long").alias("_seq"),
                      epoch_us(src, ts).alias("_us"), F.col(who).alias("_who"))
    h = with_halo(base, "_us", span, _chunk_us(span, chunk))
    part = Window.partitionBy("_key", "_chunk")
    asc = part.orderBy("_us", "_seq")
    rn = F.row_number().over(asc).cast("long")
    if chain:
        # the completion is the head of the n-th following run of equal accounts
        head = ~F.coalesce(F.lag("_who").over(asc).eqNullSafe(F.col("_who")) & (rn > 1), F.lit(False))
        rows = h.withColumn("_head", head).withColumn(
            "_at", F.sum(F.col("_head").cast("long")).over(asc.rowsBetween(Window.unboundedPreceding, 0)))
        target = F.col("_at") + n_more
        ends = rows.where("_head")
    else:
        # d: rows of other accounts so far.  The n-th other row after a start is number d + n among
        # the others; the start's own rows before it are those with at most d + n - 1 others before them
        own = F.row_number().over(Window.partitionBy("_key", "_chunk", "_who").orderBy("_us", "_seq"))
        rows = h.withColumn("_at", rn).withColumn("_d", F.col("_at") - own)
        same = (Window.partitionBy("_key", "_chunk", "_who").orderBy("_d")
                .rangeBetween(Window.unboundedPreceding, n_more - 1))
        rows = rows.withColumn("_target", F.col("_d") + n_more + F.count(F.lit(1)).over(same))
        target = F.col("_target")
        ends = rows
    starts = rows.where(F.col("_chunk") == F.col("_own")).select(
        "_key", "_chunk", F.col("_who").alias("start_who"), target.alias("_to"),
        F.col("_us").alias("s_us"), F.col("_seq").alias("s_seq"), F.col("_ts").alias("s_ts"))
    ends = ends.select(F.col("_key").alias("_k2"), F.col("_chunk").alias("_c2"), F.col("_at").alias("_to2"),
                       F.col("_us").alias("e_us"), F.col("_seq").alias("e_seq"), F.col("_ts").alias("e_ts"))
    iv = (starts.join(ends, F.col("_key").eqNullSafe(F.col("_k2")) & (F.col("_chunk") == F.col("_c2"))
                      & (F.col("_to") == F.col("_to2")))
          .where(F.col("e_us") - F.col("s_us") < F.lit(span))
          .select("_key", "start_who", "s_us", "s_seq", "s_ts", "e_us", "e_seq", "e_ts"))
    chosen = greedy_select(iv, ["_key"], span, chunk)
    cols = [F.col("_key").alias(key)] if key else []
    return chosen.select(*cols, F.col("start_who").alias(f"start_{who}"),
                         F.col("s_ts").alias("first_ts"), F.col("e_ts").alias("last_ts"))
