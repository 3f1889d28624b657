"""Reconciling two event streams: interval, outer, window joins and payment timeouts.

Time bands are joined as an equi-join on the key plus a **time-bucket** equi key
whenever keys are dense (one user has many events): the left side is copied into
the (at most two) buckets its band overlaps, the right side sits in one bucket,
so every pair is tested exactly once and a sort-merge join never scans more
than two buckets of one key.  With unique keys (transaction ids) the bucket is
pointless and ``bucket=None`` joins on the key alone.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from clickstream.functions.eventtime import duration_us, epoch_us, from_epoch_us, is_ntz
from clickstream.operators.sorted_groups import group_starts, scan_sorted_groups
from clickstream.operators.windows import floor_div
from clickstream.session import materialize, scratch_table


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def _prep(df: DataFrame, ts: str, prefix: str) -> DataFrame:
    return df.withColumn(f"{prefix}_us", epoch_us(df, ts))


def interval_join(left: DataFrame, right: DataFrame, keys, left_ts: str, right_ts: str,
                  lower, upper, bucket: str | None = "auto", how: str = "inner") -> DataFrame:
    """Pairs with equal keys and ``right.ts`` in ``[left.ts + lower, left.ts + upper]`` (inclusive).

    ``lower``/``upper`` are signed durations in seconds or strings (``"-3 s"`` is
    not parsed; pass ``-3``).  ``bucket="auto"`` adds the time-bucket key with a
    bucket as wide as the band; ``None`` joins on the keys only.  Column names of
    the two sides must not clash except for the keys.
    """
    keys = _keys(keys)
    lo, hi = _signed_us(lower), _signed_us(upper)
    if hi < lo:
        raise ValueError("upper bound below lower bound")
    if how != "inner" and bucket is not None:
        raise ValueError("the bucketed join is inner; for unmatched rows use outer_match, or bucket=None")
    l = _prep(left, left_ts, "_l")
    r = _prep(right, right_ts, "_r")
    band = (F.col("_r_us") >= F.col("_l_us") + F.lit(lo)) & (F.col("_r_us") <= F.col("_l_us") + F.lit(hi))
    if bucket is None:
        j = l.join(r, keys, how).where(band) if how == "inner" else l.join(r, _on(l, r, keys) & band, how)
        return j.drop("_l_us", "_r_us")
    width = max(hi - lo + 1, 1) if bucket == "auto" else duration_us(bucket)
    first = floor_div(F.col("_l_us") + F.lit(lo), width)
    last = floor_div(F.col("_l_us") + F.lit(hi), width)
    lb = l.withColumn("_tb", F.explode(F.sequence(first, last)))
    rb = r.withColumn("_tb", floor_div(F.col("_r_us"), width))
    return lb.join(rb, keys + ["_tb"], how).where(band).drop("_tb", "_l_us", "_r_us")


def _signed_us(d) -> int:
    if isinstance(d, str) and d.strip().startswith("-"):
        return -duration_us(d.strip()[1:])
    return duration_us(d)


def _on(l, r, keys):
    cond = None
    for k in keys:
        c = l[k] == r[k]
        cond = c if cond is None else cond & c
    return cond


def outer_match(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                lower, upper, matched: str = "matched", left_only: str = "unmatched_left",
                right_only: str = "unmatched_right", unique_keys: bool = True) -> DataFrame:
    """Full outer equi + band join: the two-stream match with both unmatched outputs.

    In event-time order the reference's rule (a pay waits ``upper`` for its
    receipt, a receipt waits ``-lower`` for its pay, one slot per key) matches
    iff ``right.ts`` is in ``[left.ts + lower, left.ts + upper]``.  Returns
    ``key, status, left_ts, right_ts`` with ``status`` one of the three labels;
    a key whose times do not fit yields one unmatched row per side; NULL keys match
    nothing and are unmatched rows of their side.

    ``unique_keys=True`` (transaction ids): one full outer join, one shuffle.
    ``unique_keys=False``: keys may repeat or be hot, so matched pairs come from
    the time-bucketed interval join and each unmatched side from a bucketed
    anti join; no key ever pairs all its rows.
    """
    lo, hi = _signed_us(lower), _signed_us(upper)
    # markers say which side a row has: a NULL key or time does not make it the other side's
    l = _prep(left.select(F.col(key).alias("_lk"), F.col(left_ts).alias("left_ts"), F.lit(True).alias("_is_l")), "left_ts", "_l")
    r = _prep(right.select(F.col(key).alias("_rk"), F.col(right_ts).alias("right_ts"), F.lit(True).alias("_is_r")), "right_ts", "_r")
    band = (F.col("_r_us") >= F.col("_l_us") + F.lit(lo)) & (F.col("_r_us") <= F.col("_l_us") + F.lit(hi))
    if unique_keys:
        j = l.join(r, (F.col("_lk") == F.col("_rk")) & band, "full")
        status = (F.when(F.col("_is_l").isNotNull() & F.col("_is_r").isNotNull(), F.lit(matched))
                  .when(F.col("_is_l").isNotNull(), F.lit(left_only)).otherwise(F.lit(right_only)))
        return j.select(F.coalesce("_lk", "_rk").alias(key), status.alias("status"), "left_ts", "right_ts")
    width = max(hi - lo + 1, 1)
    # left row's band starts in bucket floor((l + lo) / width) and ends in that or the next
    l_first = floor_div(F.col("_l_us") + F.lit(lo), width)
    r_own = floor_div(F.col("_r_us"), width)
    l1 = l.withColumn("_tb", l_first)
    l2 = l.withColumn("_tb", F.explode(F.array_distinct(F.array(l_first, floor_div(F.col("_l_us") + F.lit(hi), width)))))
    r1 = r.withColumn("_tb", r_own)
    r2 = r.withColumn("_tb", F.explode(F.array_distinct(F.array(r_own, r_own - 1))))
    on_l = lambda a, b: (a["_lk"] == b["_rk"]) & (a["_tb"] == b["_tb"]) & band
    pairs = l2.join(r1, on_l(l2, r1), "inner").select(
        F.col("_lk").alias(key), F.lit(matched).alias("status"), "left_ts", "right_ts")
    lonely_l = l1.join(r2, on_l(l1, r2), "left_anti").select(
        F.col("_lk").alias(key), F.lit(left_only).alias("status"), "left_ts",
        F.lit(None).cast(right.schema[right_ts].dataType).alias("right_ts"))
    lonely_r = r1.join(l2, on_l(l2, r1), "left_anti").select(
        F.col("_rk").alias(key), F.lit(right_only).alias("status"),
        F.lit(None).cast(left.schema[left_ts].dataType).alias("left_ts"), "right_ts")
    return pairs.unionByName(lonely_l).unionByName(lonely_r)


def window_join(left: DataFrame, right: DataFrame, keys, left_ts: str, right_ts: str, size) -> DataFrame:
    """Pairs with equal keys whose times fall in the same tumbling window of ``size``."""
    keys = _keys(keys)
    w = duration_us(size)
    l = left.withColumn("_win", floor_div(epoch_us(left, left_ts), w))
    r = right.withColumn("_win", floor_div(epoch_us(right, right_ts), w))
    return l.join(r, keys + ["_win"]).drop("_win")


class PaymentResult(NamedTuple):
    paid: DataFrame       # creates followed by a pay within the span
    timed_out: DataFrame  # creates with no pay in time (also those still open at end of input)


def payment_timeout(creates: DataFrame, pays: DataFrame, key: str, ts: str, within,
                    keep=("event_id",), write_once: bool = False) -> PaymentResult:
    """``create`` followed by ``pay`` (same key) with ``0 <= pay.ts - create.ts < within``.

    The reference's order-timeout pattern: a match is a success, a create whose
    window passes is a timeout, a pay without a create yields nothing.  Creates
    without a key or a time are timeouts.  ``paid`` also has ``pay_ts``, the captured pay's time.

    ``write_once``: both outputs are written by one job, as partitions of one table below
    the shared scratch folder, and read back from there; otherwise each output that is used
    runs the plan.
    """
    done = payment_outcomes(creates, pays, key, ts, within, keep)
    if write_once:
        got = split_outputs(done, "status", "payment")
        paid, timed = got("success"), got("timeout")
    else:
        paid, timed = done.where("status = 'success'"), done.where("status = 'timeout'")
    plain = [F.col(key), *[F.col(f"`{k}`") for k in keep]]
    return PaymentResult(paid.select(*plain, "status", "pay_ts"), timed.select(*plain, "status"))


def split_outputs(df: DataFrame, col: str, name: str):
    """Write ``df`` once, partitioned by ``col``; returns a function from a label to that label's rows.

    The named side outputs of one batch job: the plan runs once, and an output reads only its
    own files.  A label without rows gives an empty DataFrame.
    """
    spark, schema = df.sparkSession, df.schema
    path = scratch_table(spark, name)
    df.write.mode("overwrite").partitionBy(col).parquet(path)
    return lambda label: spark.read.schema(schema).parquet(path).where(F.col(col) == label).select(*[F.col(f"`{c}`") for c in df.columns])


def payment_outcomes(creates: DataFrame, pays: DataFrame, key: str, ts: str, within, keep=("event_id",)) -> DataFrame:
    """``key, <keep>, status, pay_ts`` of every create: ``success`` or ``timeout`` (then ``pay_ts`` is NULL).

    Both sides go through one shuffle: rows are tagged, unioned and cut into time
    chunks (the first ``within`` of a chunk is also copied to the end of the one
    before), and each create takes the next pay time of its key, the last one seen
    going back in time.  No create is ever paired with a pay, and a hot key is
    spread over its chunks.  Creates without a key or a time are not shuffled.
    """
    span = duration_us(within)
    chunk = max(8 * span, 3_600_000_000)
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    c = creates.where(known).select(F.col(key).alias("_k"), F.struct(*keep).alias("_keep"), epoch_us(creates, ts).alias("_us"),
                                    F.lit(False).alias("_pay"))
    p = (pays.where(known)
         .select(F.col(key).alias("_k"), F.lit(None).cast(c.schema["_keep"].dataType).alias("_keep"),
                 epoch_us(pays, ts).alias("_us"), F.lit(True).alias("_pay")))
    both = c.unionByName(p)
    own = floor_div(F.col("_us"), chunk)
    halo = F.col("_pay") & (F.col("_us") - own * F.lit(chunk) < F.lit(span))
    both = both.withColumn("_chunk", F.explode(F.when(halo, F.array(own, own - 1)).otherwise(F.array(own))))
    # going back in time; pays before creates of the same time, so that 0 is inside
    back = (Window.partitionBy("_k", "_chunk").orderBy(F.col("_us").desc(), F.col("_pay").desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nxt = F.last(F.when(F.col("_pay"), F.col("_us")), ignorenulls=True).over(back)
    done = both.withColumn("_next", nxt).where(~F.col("_pay"))
    ok = F.coalesce(F.col("_next") < F.col("_us") + F.lit(span), F.lit(False))
    pay_ts = from_epoch_us(F.col("_next"), is_ntz(pays, ts))
    found = done.select(F.col("_k").alias(key), *[F.col(f"_keep.`{k}`") for k in keep],
                        F.when(ok, F.lit("success")).otherwise(F.lit("timeout")).alias("status"), F.when(ok, pay_ts).alias("pay_ts"))
    lone = creates.where(~known).select(F.col(key), *keep, F.lit("timeout").alias("status"),
                                        F.lit(None).cast(found.schema["pay_ts"].dataType).alias("pay_ts"))
    return found.unionByName(lone)


def one_slot_match(left: DataFrame, right: DataFrame, keys, left_ts: str, right_ts: str, seq: str, lower, upper,
                   matched: str = "matched", left_only: str = "unmatched_left",
                   right_only: str = "unmatched_right", chunk=None) -> DataFrame:
    """Two-stream match with one slot per key and side, as the reference keeps it.

    In event order (left before right at equal times, then ``seq``) a key holds at most one
    waiting left and one waiting right row.  A row meets the other side's waiting row if
    that has not timed out (a left row waits ``upper``, a right row ``-lower``,
    inclusive): both are matched and both slots are empty again.  Otherwise the row
    takes its own slot; a row that was waiting there is overwritten and comes out
    unmatched.  Returns ``keys..., status, left_seq, right_seq``.  Rows without a key
    or a time are unmatched.

    A key's time line is cut into chunks.  Only one row can wait when a chunk begins (a row of
    the other side would have met it), and the chunk's first row settles it: it meets that
    row, or the row times out or is overwritten.  So a chunk behaves in one of two ways, its
    first row free or used up, and is summarised by the row that waits at its end in either
    case: a map from the previous chunk's way to its own.  The maps of a key's chunks are
    composed by a prefix scan (one row per chunk), and each chunk is then walked with its
    known entry.  A hot key is spread over its chunks.
    """
    keys = _keys(keys)
    lo, hi = _signed_us(lower), _signed_us(upper)
    if lo > 0 or hi < 0:
        raise ValueError("the band must hold 0: a row waits for the other side")
    chunk_us = duration_us(chunk) if chunk is not None else max(8 * max(hi, -lo), 3_600_000_000)
    side = lambda df, ts, is_left: df.select(
        F.when(F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)) | F.col(ts).isNull(), F.lit(None))
        .otherwise(F.to_json(F.struct(*keys))).alias("_gk"), F.struct(*keys).alias("_keys"),
        epoch_us(df, ts).alias("_us"), F.col(seq).cast("long").alias("_seq"), F.lit(is_left).alias("_left"))
    both = side(left, left_ts, True).unionByName(side(right, right_ts, False))
    lone = both.where("_gk is null")
    whole = materialize(both.where("_gk is not null").withColumn("_gc", floor_div(F.col("_us"), chunk_us)), "slot-rows")  # read twice
    group, order = ["_gk", "_gc"], ["_us", "_first", "_seq"]
    limits = {True: hi, False: -lo}
    names = [T.StructField("_gk", T.StringType()), T.StructField("_gc", T.LongType())]
    longs = lambda *cols: [T.StructField(c, T.LongType()) for c in cols]
    slim = whole.select(*group, "_us", "_seq", "_left", (~F.col("_left")).cast("int").alias("_first"))
    ends = scan_sorted_groups(slim, group, order, lambda t: _slot_ends(t, limits),
                              T.StructType(names + longs("f_us", "f_left", "us_0", "left_0", "seq_0", "us_1", "left_1", "seq_1")))
    entries = scan_sorted_groups(ends, ["_gk"], ["_gc"], lambda t: _slot_entries(t, limits),
                                 T.StructType(names + longs("in_us", "in_left", "in_seq", "is_last")))
    schema = T.StructType([whole.schema["_keys"], T.StructField("status", T.StringType()), *longs("left_seq", "right_seq")])
    labels = {True: left_only, False: right_only}
    joined = whole.withColumn("_first", (~F.col("_left")).cast("int")).join(entries, group)
    walked = scan_sorted_groups(joined, group, order, lambda t: _slot_rows(t, limits, matched, labels), schema)
    rest = lone.select("_keys", F.when(F.col("_left"), F.lit(left_only)).otherwise(F.lit(right_only)).alias("status"),
                       F.when(F.col("_left"), F.col("_seq")).alias("left_seq"),
                       F.when(~F.col("_left"), F.col("_seq")).alias("right_seq"))
    return walked.unionByName(rest).select(*[F.col(f"_keys.`{k}`") for k in keys], "status", "left_seq", "right_seq")


def _slot_walk(rows: list[tuple], waiting: tuple | None, limits: dict, put) -> tuple | None:
    """Walk ``(us, left, seq)`` rows in order; ``put(a, b)`` gets settled rows (``b`` None: alone).  Returns the row still waiting.

    One slot is enough: a row that meets the other side's waiting row empties it, so the two
    sides never wait together.
    """
    for row in rows:
        if waiting is None:
            waiting = row
        elif waiting[1] != row[1] and row[0] - waiting[0] <= limits[waiting[1]]:
            put(waiting, row)
            waiting = None
        else:  # timed out or overwritten
            put(waiting, None)
            waiting = row
    return waiting


def _slot_groups(table: pa.Table):
    """(first row number, rows) of each (key, chunk) group."""
    us, left, seq = (table[c].to_pylist() for c in ("_us", "_left", "_seq"))
    bounds = group_starts(table, ["_gk", "_gc"]).tolist() + [table.num_rows]
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield a, list(zip(us[a:b], left[a:b], seq[a:b]))


def _slot_ends(table: pa.Table, limits: dict) -> pa.Table:
    """Per chunk its first row, and the row that waits at its end if the first row is free (0) or used up (1)."""
    at, out = [], []
    for a, rows in _slot_groups(table):
        at.append(a)
        ends = [_slot_walk(rows[k:], None, limits, lambda x, y: None) or (None, None, None) for k in (0, 1)]
        out.append((rows[0][0], int(rows[0][1]), *(x if x is None else int(x) for end in ends for x in end)))
    cols = list(zip(*out)) or [[]] * 8
    res = table.select(["_gk", "_gc"]).take(pa.array(at, pa.int64()))
    for name, col in zip(("f_us", "f_left", "us_0", "left_0", "seq_0", "us_1", "left_1", "seq_1"), cols):
        res = res.append_column(name, pa.array(col, pa.int64()))
    return res


def _slot_entries(table: pa.Table, limits: dict) -> pa.Table:
    """The row that waits when each chunk begins, by composing the chunks' maps."""
    n = table.num_rows
    head = np.zeros(n, bool)
    head[group_starts(table, ["_gk"])] = True
    num = lambda c: table[c].fill_null(0).to_numpy()
    f_us, f_left = num("f_us"), num("f_left")
    ends = [(table[f"us_{v}"].is_valid().to_numpy(), num(f"us_{v}"), num(f"left_{v}"), num(f"seq_{v}")) for v in (0, 1)]
    way = np.zeros((n, 2), np.int64)  # a chunk's way (1: its first row is used up) by the way of the one before
    for v, (some, us, left, _) in enumerate(ends):
        wait = np.where(left[:-1] == 1, limits[True], limits[False])
        way[1:, v] = some[:-1] & (left[:-1] != f_left[1:]) & (f_us[1:] - us[:-1] <= wait)
    way[head] = 0  # a key's first chunk has nothing before it, so a map never reaches into another key
    step = 1
    while step < n:
        way[step:] = np.take_along_axis(way[step:], way[:-step].copy(), axis=1)
        step *= 2
    own = way[:, 0]
    before = np.append(0, own[:-1])
    pick = lambda k: np.append(0, np.where(before[1:] == 0, ends[0][k][:-1], ends[1][k][:-1]))
    none = head | (pick(0) == 0)
    res = table.select(["_gk", "_gc"])
    for name, k in (("in_us", 1), ("in_left", 2), ("in_seq", 3)):
        res = res.append_column(name, pa.array(pick(k).astype(np.int64), mask=none))
    return res.append_column("is_last", pa.array(np.append(head[1:], True).astype(np.int64)))


def _slot_rows(table: pa.Table, limits: dict, matched: str, labels: dict) -> pa.Table:
    """Every chunk's settled rows: those of the row that waited at its beginning, and at a key's end of the one still waiting."""
    in_us, in_left, in_seq, is_last = (table[c].to_pylist() for c in ("in_us", "in_left", "in_seq", "is_last"))
    at, status, ls, rs = [], [], [], []
    for a, rows in _slot_groups(table):
        def put(x, y):
            one, two = (x, y) if x[1] else (y, x)
            at.append(a)
            status.append(matched if y is not None else labels[x[1]])
            ls.append(one and one[2])
            rs.append(two and two[2])

        entry = None if in_us[a] is None else (in_us[a], bool(in_left[a]), in_seq[a])
        end = _slot_walk(rows, entry, limits, put)
        if end is not None and is_last[a]:
            put(end, None)
    return pa.table({"_keys": table["_keys"].take(pa.array(at, pa.int64())), "status": pa.array(status, pa.string()),
                     "left_seq": pa.array(ls, pa.int64()), "right_seq": pa.array(rs, pa.int64())})
