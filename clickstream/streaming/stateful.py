"""Keyed stateful twins built on ``transformWithStateInPandas``.

Rows reach a stateful processor in arrival order, batch by batch.  To give the
batch answer ("ordered by event time, ties by seq"), each processor buffers a
key's rows by time bucket in map state and releases them in ``(ts, seq)`` order once the
watermark has passed them; an event-time timer at the oldest buffered row
drives the release.  State per key is the buffer (rows within the watermark
delay) plus a few values; it is cleared when the key can receive no more rows.

These processors need the RocksDB state store provider
(:data:`ROCKSDB_PROVIDER`, set by :func:`use_rocksdb`).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickstream.functions.eventtime import duration_us
from clickstream.operators.matching import _keys, _signed_us, _slot_walk
from clickstream.session import ship_package

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000
#: Buffered rows of one state entry at most.
PART_ROWS = 10_000


def use_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def _prepare(df: DataFrame, ts: str, delay) -> DataFrame:
    ship_package(df.sparkSession)
    return _prepare_cols(df, ts, delay)


def _prepare_cols(df: DataFrame, ts: str, delay) -> DataFrame:
    """Watermarked ``cs_et`` plus ``cs_us`` (epoch micros) used by the processors.

    (Columns handed to a pandas processor must not start with ``_``: such names
    arrive renamed by position.)
    """
    return (df.withColumn("cs_et", F.col(ts).cast("timestamp"))
            .withColumn("cs_us", F.unix_micros(F.col("cs_et")))
            .withWatermark("cs_et", f"{duration_us(delay)} microseconds"))


class _Buffered(StatefulProcessor):
    """Buffer rows; release those at or before the watermark in order (``n_order`` leading columns, time first).

    The buffer is map state by time bucket of ``width_us``.  A micro-batch adds its rows of a
    bucket as new parts, so nothing buffered before is read or written again; an index holds
    each bucket's number of parts and rows and its oldest time.  A release reads the buckets
    that the watermark has reached and puts back at most the rest of the last of them.
    ``release`` also runs, with nothing ready, when a timer it armed for clearing idle state expires.
    """

    buf_schema: T.StructType
    width_us = 60_000_000
    n_order = 2

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        longs = lambda *names: T.StructType([T.StructField(n, T.LongType()) for n in names])
        self.parts = handle.getMapState("parts", longs("bucket", "part"),
                                        T.StructType([T.StructField("rows", T.ArrayType(self.buf_schema))]))
        self.index = handle.getMapState("index", longs("bucket"), longs("parts", "rows", "lo"))
        self.timer = handle.getValueState("timer", longs("ms"))

    def _arm(self, ms: int) -> None:
        if self.timer.exists():
            cur = self.timer.get()[0]
            if cur <= ms:
                return
            self.handle.deleteTimer(cur)
        self.handle.registerTimer(ms)
        self.timer.update((ms,))

    def _buckets(self) -> list[tuple]:
        """``(bucket, parts, rows, lo)`` of the buffer, oldest first."""
        return sorted((k[0], *v) for k, v in self.index.iterator())

    def _add(self, rows: list[tuple]) -> None:
        new: dict[int, list[tuple]] = {}
        for r in rows:
            new.setdefault(r[0] // self.width_us, []).append(r)
        for b, mine in new.items():
            lo = min(r[0] for r in mine)
            parts, n, old = self.index.getValue((b,)) if self.index.containsKey((b,)) else (0, 0, lo)
            for a in range(0, len(mine), PART_ROWS):
                self.parts.updateValue((b, parts), (mine[a:a + PART_ROWS],))
                parts += 1
            self.index.updateValue((b,), (parts, n + len(mine), min(lo, old)))

    def _drop(self, bucket: int, parts: int) -> None:
        for p in range(parts):
            self.parts.removeKey((bucket, p))
        self.index.removeKey((bucket,))

    def _take(self, bucket: int, parts: int) -> list[tuple]:
        rows = [tuple(r) for p in range(parts) for r in self.parts.getValue((bucket, p))[0]]
        self._drop(bucket, parts)
        return rows

    def _new_rows(self, rows: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        cols = [f.name for f in self.buf_schema.fields]
        for pdf in rows:
            yield from map(self.as_state, pdf[cols].itertuples(index=False, name=None))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = list(self._new_rows(rows))
        if new:
            self._add(new)
            self._arm(-(-min(r[0] for r in new) // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        ready, waiting = [], []
        for bucket, parts, _, lo in self._buckets():
            if lo > wm_us:
                waiting.append(lo)
                continue
            rows = self._take(bucket, parts)
            ready += [r for r in rows if r[0] <= wm_us]
            later = [r for r in rows if r[0] > wm_us]
            if later:
                self._add(later)
                waiting.append(min(r[0] for r in later))
        if waiting:
            self._arm(-(-min(waiting) // 1000))
        out = self.release(key, sorted(ready, key=lambda r: r[:self.n_order]), timerValues)
        if out is not None and len(out):
            yield out

    def as_state(self, r) -> tuple:
        """A buffered row as plain Python values (state encoders reject numpy scalars)."""
        out = []
        for f, v in zip(self.buf_schema.fields, r):
            if v is None or (isinstance(v, float) and v != v):
                out.append(None)
            elif isinstance(f.dataType, T.LongType):
                out.append(int(v))
            elif isinstance(f.dataType, T.DoubleType):
                out.append(float(v))
            elif isinstance(f.dataType, T.BooleanType):
                out.append(bool(v))
            else:
                out.append(str(v))
        return tuple(out)

    def release(self, key, ready, timerValues):  # pragma: no cover - abstract
        raise NotImplementedError

    def close(self) -> None:
        pass


class QuotaProcessor(_Buffered):
    """Per (keys, day): the first ``max_count`` rows pass, the next one warns.

    Only the ``max_count + 1`` smallest positions not yet released can matter, so the buffer
    holds at most twice that many however often a key clicks; once the warning is out, later
    rows are not kept at all.
    """

    def __init__(self, key_names, max_count):
        self.key_names = list(key_names)
        self.max_count = max_count
        self.buf_schema = T.StructType([T.StructField("cs_us", T.LongType()), T.StructField("seq", T.LongType())])

    def init(self, handle):
        super().init(handle)
        self.count = handle.getValueState("count", T.StructType([T.StructField("n", T.LongType())]))

    def _released(self) -> int:
        return self.count.get()[0] if self.count.exists() else 0

    def handleInputRows(self, key, rows, timerValues):
        room = self.max_count + 1 - self._released()
        new = heapq.nsmallest(room, self._new_rows(rows))  # rows come after all released ones
        if new:
            self._add(new)
            self._arm(-(-new[0][0] // 1000))
            self._trim(room)
        return iter([])

    def _trim(self, room: int) -> None:
        held = 0
        for bucket, parts, n, _ in self._buckets():
            if held >= room:
                self._drop(bucket, parts)
            elif held + n > 2 * room:
                self._add(sorted(self._take(bucket, parts))[:room - held])
            held += n

    def release(self, key, ready, timerValues):
        n = self._released()
        out = []
        for us, seq in ready[:self.max_count + 1 - n]:
            n += 1
            out.append((*key, us, seq, "pass" if n <= self.max_count else "warn"))
        left = self._buckets()
        if n > self.max_count:
            for bucket, parts, _, _ in left:
                self._drop(bucket, parts)
            left = []
        # the key holds one UTC day: after its end no row can come any more
        day_end_ms = (int(key[-1]) + 1) * DAY_MS
        if timerValues.getCurrentWatermarkInMs() >= day_end_ms and not left:
            self.count.clear()
        else:
            self.count.update((n,))
            self._arm(day_end_ms)
        return pd.DataFrame(out, columns=[*self.key_names, "cs_day", "cs_us", "seq", "status"])


def stream_quota_filter(events: DataFrame, keys, ts: str, seq: str, max_count: int = 100,
                        delay="0 seconds") -> DataFrame:
    """Twin of ``quota_filter``: ``keys..., day, ts, seq, status`` (``pass`` / ``warn``).

    ``status = 'pass'`` rows are the quota's passed events (join back on
    ``seq`` for other columns); the ``warn`` row is the blacklist warning.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ev = _prepare(events.withColumnRenamed(seq, "seq"), ts, delay)
    ev = ev.withColumn("cs_day", F.floor(F.col("cs_us") / (DAY_MS * 1000)).cast("long"))
    fields = [ev.schema[k] for k in keys]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [
        T.StructField("cs_day", T.LongType()), T.StructField("cs_us", T.LongType()),
        T.StructField("seq", T.LongType()), T.StructField("status", T.StringType())])
    out = (ev.select(*keys, "cs_day", "cs_et", "cs_us", F.col("seq").cast("long").alias("seq"))
           .groupBy(*keys, "cs_day")
           .transformWithStateInPandas(QuotaProcessor(keys, max_count), schema, "append", "EventTime"))
    ntz = isinstance(events.schema[ts].dataType, T.TimestampNTZType)
    t = F.timestamp_micros("cs_us")
    return out.select(*keys, F.date_from_unix_date(F.col("cs_day").cast("int")).alias("day"),
                      (t.cast("timestamp_ntz") if ntz else t).alias(ts), F.col("seq").alias(seq), "status")


class ConsecutiveProcessor(_Buffered):
    """``n`` adjacent rows all flagged, spanning less than ``span_us`` (every start)."""

    def __init__(self, key_names, n, span_us):
        self.key_names = list(key_names)
        self.n, self.span_us = n, span_us
        self.buf_schema = T.StructType([T.StructField("cs_us", T.LongType()), T.StructField("seq", T.LongType()),
                                        T.StructField("cs_ok", T.BooleanType())])

    def init(self, handle):
        super().init(handle)
        # the last n-1 released rows: a match may start in them
        self.tail = handle.getListState("tail", self.buf_schema)

    def release(self, key, ready, timerValues):
        seq_rows = list(self.tail.get()) + ready
        out = []
        start = max(0, len(seq_rows) - len(ready) - (self.n - 1))
        for i in range(start, len(seq_rows) - self.n + 1):
            run = seq_rows[i:i + self.n]
            if i + self.n - 1 < len(seq_rows) - len(ready):
                continue  # fully inside the old tail: already judged
            if all(r[2] for r in run) and run[-1][0] - run[0][0] < self.span_us:
                out.append((*key, run[0][0], run[-1][0]))
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        # rows from which a match can still start: within the span of what may still come
        keep = [r for r in seq_rows[-(self.n - 1):] if r[0] + self.span_us > wm_us] if self.n > 1 else []
        if keep:
            self.tail.put(keep)
            self._arm(-(-(keep[-1][0] + self.span_us) // 1000))
        else:
            self.tail.clear()
        return pd.DataFrame(out, columns=[*self.key_names, "cs_first", "cs_last"])


def stream_consecutive(events: DataFrame, keys, ts: str, seq: str, cond, within, n: int = 2,
                       delay="0 seconds") -> DataFrame:
    """Twin of ``sequence.consecutive``: ``keys..., first_ts, last_ts``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    ev = _prepare(events, ts, delay)
    fields = [ev.schema[k] for k in keys]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [
        T.StructField("cs_first", T.LongType()), T.StructField("cs_last", T.LongType())])
    out = (ev.select(*keys, "cs_et", "cs_us", F.col(seq).cast("long").alias("seq"), cond.alias("cs_ok"))
           .groupBy(*keys)
           .transformWithStateInPandas(ConsecutiveProcessor(keys, n, duration_us(within)), schema,
                                       "append", "EventTime"))
    ntz = isinstance(events.schema[ts].dataType, T.TimestampNTZType)

    def conv(c):
        t = F.timestamp_micros(c)
        return t.cast("timestamp_ntz") if ntz else t
    return out.select(*keys, conv("cs_first").alias("first_ts"), conv("cs_last").alias("last_ts"))


class SequenceProcessor(_Buffered):
    """Skip-past-last-event rules over a key's released events.

    State: the released events of the last ``span`` (possible starts) and the
    end of the last emitted match.  For each newly released event, the
    candidates completing exactly there are found; the earliest start after
    the last emitted end wins (the pattern library's emission order).

    ``rule``: ``blocks`` (``n`` events), ``threshold`` (event with value above
    ``threshold`` then the adjacent event), ``follow`` (``n`` later events whose
    ``who`` differs from the start's, or from the previous one with ``chain``),
    ``span`` (``n`` events, no skip: every start is emitted, matches overlap).
    """

    def __init__(self, key_names, rule, span_us, n=2, threshold=0.0, chain=False):
        self.key_names = list(key_names)
        self.rule, self.span_us, self.n, self.threshold, self.chain = rule, span_us, n, threshold, chain
        self.buf_schema = T.StructType([T.StructField("cs_us", T.LongType()), T.StructField("seq", T.LongType()),
                                        T.StructField("cs_val", T.DoubleType()), T.StructField("cs_who", T.StringType())])

    def init(self, handle):
        super().init(handle)
        self.hist = handle.getListState("hist", self.buf_schema)
        self.last = handle.getValueState("last", T.StructType([T.StructField("us", T.LongType()),
                                                               T.StructField("seq", T.LongType())]))
        # open partial matches of the follow rule: start position, start who, who to differ from, captured
        self.partials = handle.getListState("partials", T.StructType([
            T.StructField("s_us", T.LongType()), T.StructField("s_seq", T.LongType()),
            T.StructField("s_who", T.StringType()), T.StructField("ref", T.StringType()),
            T.StructField("got", T.LongType())]))

    def _release_follow(self, key, ready, wm_us):
        """Advance every open partial match by each released event (linear per event)."""
        partials = [tuple(p) for p in self.partials.get()]
        out = []
        for us, seq, _val, who in ready:
            alive, done = [], []
            for su, sq, sw, ref, got in partials:
                if us - su >= self.span_us:
                    continue  # timed out
                if who != ref:
                    got += 1
                    if self.chain:
                        ref = who
                    if got == self.n:
                        done.append((su, sq, sw))
                        continue
                alive.append((su, sq, sw, ref, got))
            partials = alive
            if done:
                su, sq, sw = min(done)  # earliest start wins
                out.append((*key, su, us, sw))
                partials = []  # skip past last event: every open partial started before it
            else:
                partials.append((us, seq, who, who, 0))
        partials = [p for p in partials if p[0] + self.span_us > wm_us]
        if partials:
            self.partials.put(partials)
            self._arm(-(-(partials[-1][0] + self.span_us) // 1000))
        else:
            self.partials.clear()
        return pd.DataFrame(out, columns=[*self.key_names, "cs_first", "cs_last", "cs_who"])

    def _completes_at(self, ev, j):
        """Start indexes whose partial match completes exactly at event ``j``."""
        us = ev[j][0]
        if self.rule in ("blocks", "span"):
            s = j - (self.n - 1)
            return [s] if s >= 0 and us - ev[s][0] < self.span_us else []
        if self.rule == "threshold":
            s = j - 1
            return [s] if s >= 0 and ev[s][2] is not None and ev[s][2] > self.threshold \
                and us - ev[s][0] < self.span_us else []
        raise ValueError(f"unknown rule {self.rule}")

    def release(self, key, ready, timerValues):
        if self.rule == "follow":
            return self._release_follow(key, ready, timerValues.getCurrentWatermarkInMs() * 1000)
        hist = list(self.hist.get())
        ev = hist + ready
        last = tuple(self.last.get()) if self.last.exists() else None
        out = []
        for j in range(len(hist), len(ev)):
            for s in self._completes_at(ev, j):
                if self.rule == "span":  # no skip strategy: every match is emitted
                    out.append((*key, ev[s][0], ev[j][0], ev[s][3]))
                elif last is None or (ev[s][0], ev[s][1]) > last:
                    out.append((*key, ev[s][0], ev[j][0], ev[s][3]))
                    last = (ev[j][0], ev[j][1])
                    break
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        newest = ev[-1][0] if ev else None
        keep = [e for e in ev if newest - e[0] < self.span_us and e[0] + self.span_us > wm_us]
        if keep:
            self.hist.put(keep)
            if last is not None:
                self.last.update(last)
            self._arm(-(-(keep[-1][0] + self.span_us) // 1000))
        else:  # no start can complete any more, and later starts lie after the last match
            self.hist.clear()
            self.last.clear()
        return pd.DataFrame(out, columns=[*self.key_names, "cs_first", "cs_last", "cs_who"])


def stream_sequence(events: DataFrame, keys, ts: str, seq: str, rule: str, within, n: int = 2,
                    threshold: float = 0.0, value: str | None = None, who: str | None = None,
                    chain: bool = False, cond=None, delay="0 seconds") -> DataFrame:
    """Streaming twin of ``blocks`` / ``threshold_then_next`` / ``follow_distinct``.

    Returns ``keys..., first_ts, last_ts`` (plus ``start_<who>`` for ``follow``).
    Events not meeting ``cond`` are dropped first (relaxed contiguity rules).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    src = events if cond is None else events.where(cond)
    ev = _prepare(src, ts, delay)
    val = F.col(value).cast("double") if value else F.lit(None).cast("double")
    w = F.col(who).cast("string") if who else F.lit(None).cast("string")
    fields = [ev.schema[k] for k in keys]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [
        T.StructField("cs_first", T.LongType()), T.StructField("cs_last", T.LongType()),
        T.StructField("cs_who", T.StringType())])
    proc = SequenceProcessor(keys, rule, duration_us(within), n=n, threshold=threshold, chain=chain)
    out = (ev.select(*keys, "cs_et", "cs_us", F.col(seq).cast("long").alias("seq"), val.alias("cs_val"),
                     w.alias("cs_who"))
           .groupBy(*keys).transformWithStateInPandas(proc, schema, "append", "EventTime"))
    ntz = isinstance(events.schema[ts].dataType, T.TimestampNTZType)

    def conv(c):
        t = F.timestamp_micros(c)
        return t.cast("timestamp_ntz") if ntz else t
    cols = [*keys, conv("cs_first").alias("first_ts"), conv("cs_last").alias("last_ts")]
    if rule == "follow" and who:
        cols.append(F.col("cs_who").cast(events.schema[who].dataType).alias(f"start_{who}"))
    return out.select(*cols)


class BurstProcessor(_Buffered):
    """Failure bursts: a group opened by a fail takes the run's fails within ``span``."""

    def __init__(self, key_names, min_count, span_us):
        self.key_names = list(key_names)
        self.min_count, self.span_us = min_count, span_us
        self.buf_schema = T.StructType([T.StructField("cs_us", T.LongType()), T.StructField("seq", T.LongType()),
                                        T.StructField("cs_ok", T.BooleanType())])

    def init(self, handle):
        super().init(handle)
        self.group = handle.getValueState("group", T.StructType([
            T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
            T.StructField("size", T.LongType())]))

    def release(self, key, ready, timerValues):
        g = list(self.group.get()) if self.group.exists() else None
        out = []

        def close():
            if g is not None and g[2] >= self.min_count:
                out.append((*key, g[0], g[1], g[2]))

        for us, _seq, fail in ready:
            if not fail:
                close()
                g = None
            elif g is not None and us <= g[0] + self.span_us:
                g = [g[0], us, g[2] + 1]
            else:
                close()
                g = [us, us, 1]
        if g is not None and timerValues.getCurrentWatermarkInMs() * 1000 > g[0] + self.span_us:
            close()
            g = None
        if g is None:
            self.group.clear()
        else:
            self.group.update(tuple(g))
            self._arm(-(-(g[0] + self.span_us + 1) // 1000))  # the group can only grow until then
        return pd.DataFrame(out, columns=[*self.key_names, "cs_first", "cs_last", "times"])


def stream_burst(events: DataFrame, keys, ts: str, seq: str, is_fail, min_count: int, span,
                 delay="0 seconds") -> DataFrame:
    """Streaming twin of ``sequence.burst``: ``keys..., first_ts, last_ts, times``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    ev = _prepare(events, ts, delay)
    fields = [ev.schema[k] for k in keys]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [
        T.StructField("cs_first", T.LongType()), T.StructField("cs_last", T.LongType()),
        T.StructField("times", T.LongType())])
    out = (ev.select(*keys, "cs_et", "cs_us", F.col(seq).cast("long").alias("seq"), F.coalesce(is_fail, F.lit(False)).alias("cs_ok"))
           .groupBy(*keys).transformWithStateInPandas(BurstProcessor(keys, min_count, duration_us(span)), schema,
                                                      "append", "EventTime"))
    ntz = isinstance(events.schema[ts].dataType, T.TimestampNTZType)

    def conv(c):
        t = F.timestamp_micros(c)
        return t.cast("timestamp_ntz") if ntz else t
    return out.select(*keys, conv("cs_first").alias("first_ts"), conv("cs_last").alias("last_ts"), "times")


class PaymentProcessor(_Buffered):
    """Creates wait for the next pay of their key; state is the open creates, never a pair."""

    def __init__(self, key_names, span_us):
        self.key_names, self.span_us = list(key_names), span_us
        self.buf_schema = T.StructType([T.StructField("cs_us", T.LongType()), T.StructField("cs_id", T.StringType()),
                                        T.StructField("cs_pay", T.BooleanType())])

    def init(self, handle):
        super().init(handle)
        self.open = handle.getListState("open", T.StructType([T.StructField("us", T.LongType()),
                                                              T.StructField("id", T.StringType())]))

    def release(self, key, ready, timerValues):
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [tuple(x) for x in self.open.get()]
        out = []
        for us, id_, pay in sorted(ready, key=lambda r: (r[0], r[2])):  # a create first at equal times
            if not pay:
                waiting.append((us, id_))
                continue
            out += [(*key, i, "success" if us - u < self.span_us else "timeout") for u, i in waiting]
            waiting = []
        out += [(*key, i, "timeout") for u, i in waiting if u + self.span_us <= wm_us]
        waiting = [x for x in waiting if x[0] + self.span_us > wm_us]
        if waiting:
            self.open.put(waiting)
            self._arm(-(-(waiting[0][0] + self.span_us) // 1000))
        else:
            self.open.clear()
        return pd.DataFrame(out, columns=[*self.key_names, "cs_id", "status"])


def stream_payment_timeout(creates: DataFrame, pays: DataFrame, key: str, ts: str, within, id_col: str,
                           delay="0 seconds") -> DataFrame:
    """Twin of ``payment_timeout``: ``key, <id_col>, status`` (``success`` / ``timeout``), one row per create.

    A create is reported as soon as its pay is released, or once the watermark passes its
    span.  The watermark is the slower input's.
    """
    c = _prepare(creates, ts, delay).select(key, "cs_et", "cs_us", F.col(id_col).cast("string").alias("cs_id"),
                                            F.lit(False).alias("cs_pay"))
    p = _prepare(pays, ts, delay).select(key, "cs_et", "cs_us", F.lit("").alias("cs_id"), F.lit(True).alias("cs_pay"))
    schema = T.StructType([T.StructField(key, creates.schema[key].dataType), T.StructField("cs_id", T.StringType()),
                           T.StructField("status", T.StringType())])
    out = (c.unionByName(p).where(F.col(key).isNotNull()).groupBy(key)
           .transformWithStateInPandas(PaymentProcessor([key], duration_us(within)), schema, "append", "EventTime"))
    return out.select(key, F.col("cs_id").cast(creates.schema[id_col].dataType).alias(id_col), "status")


class OneSlotProcessor(_Buffered):
    """One waiting row per key; a row of the other side in time meets it, else it comes out alone.

    The reference keeps a slot per side.  The two never hold a row together (the later one
    would have met the earlier or found it timed out), so one value with its side is enough,
    and one event-time timer at the end of its wait.
    """

    n_order = 3

    def __init__(self, key_names, limits, matched, labels):
        self.key_names, self.limits, self.matched, self.labels = list(key_names), limits, matched, labels
        self.buf_schema = T.StructType([T.StructField(c, T.LongType()) for c in ("cs_us", "cs_right", "seq")])

    def init(self, handle):
        super().init(handle)
        self.slot = handle.getValueState("slot", T.StructType([
            T.StructField("us", T.LongType()), T.StructField("left", T.BooleanType()), T.StructField("seq", T.LongType())]))

    def release(self, key, ready, timerValues):
        out = []

        def put(a, b):
            one, two = (a, b) if a[1] else (b, a)
            out.append((*key, self.matched if b is not None else self.labels[a[1]], one and one[2], two and two[2]))

        waiting = tuple(self.slot.get()) if self.slot.exists() else None
        waiting = _slot_walk([(us, not right, seq) for us, right, seq in ready], waiting, self.limits, put)
        # rows still to come are later than the watermark
        if waiting is not None and waiting[0] + self.limits[waiting[1]] <= timerValues.getCurrentWatermarkInMs() * 1000:
            put(waiting, None)
            waiting = None
        if waiting is None:
            self.slot.clear()
        else:
            self.slot.update(waiting)
            self._arm(-(-(waiting[0] + self.limits[waiting[1]]) // 1000))
        got = pd.DataFrame(out, columns=[*self.key_names, "status", "left_seq", "right_seq"])
        return got.astype({"left_seq": "Int64", "right_seq": "Int64"})


def stream_one_slot_match(left: DataFrame, right: DataFrame, keys, left_ts: str, right_ts: str, seq: str, lower, upper,
                          matched: str = "matched", left_only: str = "unmatched_left",
                          right_only: str = "unmatched_right", delay="0 seconds") -> DataFrame:
    """Twin of ``one_slot_match``: ``keys..., status, left_seq, right_seq``.

    Both inputs are tagged and unioned; the watermark is the slower one's.  A match comes out
    when its later row is released, a lone row when it is overwritten or the watermark has
    passed its wait.  Rows without a key or a time never wait: they come out unmatched at once.
    """
    keys = _keys(keys)
    lo, hi = _signed_us(lower), _signed_us(upper)
    if lo > 0 or hi < 0:
        raise ValueError("the band must hold 0: a row waits for the other side")
    labels = {True: left_only, False: right_only}
    longs = [T.StructField("left_seq", T.LongType()), T.StructField("right_seq", T.LongType())]
    sides, lone = [], []
    for df, ts, is_left in ((left, left_ts, True), (right, right_ts, False)):
        known = F.least(*[F.col(k).isNotNull() for k in keys], F.col(ts).isNotNull())
        sides.append(_prepare(df.where(known), ts, delay).select(
            *keys, "cs_et", "cs_us", F.lit(0 if is_left else 1).cast("long").alias("cs_right"), F.col(seq).cast("long").alias("seq")))
        own, none = F.col(seq).cast("long"), F.lit(None).cast("long")
        lone.append(df.where(~known).select(*keys, F.lit(labels[is_left]).alias("status"),
                                            (own if is_left else none).alias("left_seq"),
                                            (none if is_left else own).alias("right_seq")))
    schema = T.StructType([left.schema[k] for k in keys] + [T.StructField("status", T.StringType()), *longs])
    met = (sides[0].unionByName(sides[1]).groupBy(*keys)
           .transformWithStateInPandas(OneSlotProcessor(keys, {True: hi, False: -lo}, matched, labels), schema,
                                       "append", "EventTime"))
    return met.unionByName(lone[0]).unionByName(lone[1])


class RunningVisitorsProcessor(_Buffered):
    """Per window: one row per first visit of a hash position, with the count so far.

    The count is sequential within a window, as in the reference, so a window is
    one task; only different windows run in parallel.  The map state of seen positions plays the reference's per-window bitmap;
    it is dropped once the watermark passes the window end (no row can come).
    """

    def __init__(self, size_us):
        self.size_us = size_us
        self.buf_schema = T.StructType([T.StructField("cs_us", T.LongType()), T.StructField("seq", T.LongType()),
                                        T.StructField("cs_h", T.LongType()), T.StructField("cs_user", T.StringType())])

    def init(self, handle):
        super().init(handle)
        self.seen = handle.getMapState("seen", T.StructType([T.StructField("h", T.LongType())]),
                                       T.StructType([T.StructField("x", T.BooleanType())]))
        self.count = handle.getValueState("count", T.StructType([T.StructField("n", T.LongType())]))

    def release(self, key, ready, timerValues):
        n = self.count.get()[0] if self.count.exists() else 0
        out = []
        for us, _seq, h, user in ready:
            if not self.seen.containsKey((h,)):
                self.seen.updateValue((h,), (True,))
                n += 1
                out.append((key[0], user, n))
        end_us = int(key[0])
        if timerValues.getCurrentWatermarkInMs() * 1000 >= end_us and not self._buckets():
            self.seen.clear()
            self.count.clear()
        else:
            self.count.update((n,))
            self._arm(-(-end_us // 1000))
        return pd.DataFrame(out, columns=["cs_end", "cs_user", "uv_so_far"])


def stream_running_visitors(events: DataFrame, ts: str, user: str, seq: str, size="1 hour",
                            delay="0 seconds") -> DataFrame:
    """Streaming twin of ``running_visitors``: ``window_end, <user>, uv_so_far``."""
    from clickstream.functions.hashing import hash28
    size_us = duration_us(size)
    ev = _prepare(events.where(F.col(user).isNotNull()), ts, delay)
    ev = ev.select("cs_et", "cs_us", F.col(seq).cast("long").alias("seq"),
                   hash28(user).cast("long").alias("cs_h"), F.col(user).cast("string").alias("cs_user"),
                   ((F.floor(F.col("cs_us") / size_us) + 1) * size_us).cast("long").alias("cs_end"))
    schema = T.StructType([T.StructField("cs_end", T.LongType()), T.StructField("cs_user", T.StringType()),
                           T.StructField("uv_so_far", T.LongType())])
    out = ev.groupBy("cs_end").transformWithStateInPandas(RunningVisitorsProcessor(size_us), schema, "append",
                                                          "EventTime")
    ntz = isinstance(events.schema[ts].dataType, T.TimestampNTZType)
    end = F.timestamp_micros("cs_end")
    return out.select((end.cast("timestamp_ntz") if ntz else end).alias("window_end"),
                      F.col("cs_user").cast(events.schema[user].dataType).alias(user),
                      F.col("uv_so_far"))
