"""Streaming twins equal their batch operators once the watermark has passed."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from clickstream.operators.matching import interval_join, outer_match, payment_timeout
from clickstream.operators.quota import quota_filter
from clickstream.operators.sequence import consecutive
from clickstream.operators.visitors import unique_visitors
from clickstream.operators.windows import top_n, window_count
from clickstream.sources.tables import item_key
from clickstream.streaming import (
    run_available, stream_consecutive, stream_interval_join, stream_outer_match, stream_payment_timeout,
    stream_quota_filter, stream_unique_visitors, stream_window_count, top_n_per_batch,
)
from clickstream.streaming.runner import SENTINEL_TS
from clickstream.streaming.stateful import use_rocksdb
from helpers import SF_SMALL

DELAY = "2 hours"
_n = [0]


def _name(prefix):
    _n[0] += 1
    return f"{prefix}_{_n[0]}"


@pytest.fixture(scope="module")
def events(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("k", item_key())
    return ev


@pytest.fixture(scope="module")
def stream_dir(spark, events):
    """Events as 5 files in time order; rows shuffled inside a file, some moved one file
    later (late, but within the delay); a sentinel file last."""
    rows = sorted(events.collect(), key=lambda r: r.ts)
    rnd = random.Random(11)
    parts = [rows[i * len(rows) // 5:(i + 1) * len(rows) // 5] for i in range(5)]
    for i in range(4):
        cutoff = parts[i][-1].ts - dt.timedelta(hours=1)
        moved = [r for r in parts[i] if r.ts >= cutoff and rnd.random() < 0.5]
        parts[i] = [r for r in parts[i] if r not in moved]
        parts[i + 1] = moved + parts[i + 1]
    d = tempfile.mkdtemp(prefix="cs-stream-in-")
    for i, p in enumerate(parts):
        rnd.shuffle(p)
        spark.createDataFrame(p, events.schema).coalesce(1).write.parquet(os.path.join(d, f"part{i}"))
    # far too late: older than the last file's watermark by much more than the delay -> dropped
    late_ts = rows[0].ts
    late = spark.createDataFrame([(10**8 + i, late_ts + dt.timedelta(seconds=i), 999_999, t, 500.0, '{"k": 1}', 1)
                                  for i, t in enumerate(("view", "click", "error", "error", "signup", "purchase"))],
                                 events.schema)
    late.coalesce(1).write.parquet(os.path.join(d, "part5"))
    sentinel = spark.createDataFrame([(10**9, SENTINEL_TS, 10**9, t, 0.0, '{"k": 0}', 0)
                                      for t in ("view", "click", "signup", "purchase", "error")], events.schema)
    sentinel.coalesce(1).write.parquet(os.path.join(d, "part9"))
    return d


@pytest.fixture()
def stream(spark, events, stream_dir):
    """A fresh file stream over the test folder, one file per micro-batch."""
    def make():
        return (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
                .option("recursiveFileLookup", "true").parquet(stream_dir))
    return make


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _before_sentinel(df, col):
    return df.where(F.col(col) < F.lit(SENTINEL_TS - dt.timedelta(days=1)))


def test_window_count_twin(spark, events, stream):
    views = stream().where("event_type = 'view'")
    got = run_available(stream_window_count(views, "ts", "1 hour", "5 minutes", keys=["k"], delay=DELAY),
                        _name("wc"))
    want = window_count(events.where("event_type = 'view'"), "ts", "1 hour", "5 minutes", keys=["k"])
    cols = ["k", "window_start", "window_end", "cnt"]
    assert _rows(_before_sentinel(got, "window_end"), cols) == _rows(want, cols)


def test_top_n_twin(spark, events, stream):
    out = []

    def sink(df, epoch):
        out.extend(tuple(r) for r in df.select("window_end", "rank", "k", "cnt").collect())
    views = stream().where("event_type = 'view'")
    run_available(stream_window_count(views, "ts", "1 hour", "5 minutes", keys=["k"], delay=DELAY),
                  _name("topn"), foreach_batch=top_n_per_batch(3, sink, key="k"))
    want = top_n(window_count(events.where("event_type = 'view'"), "ts", "1 hour", "5 minutes", keys=["k"]),
                 3, key="k")
    got = sorted(r for r in out if r[0] < SENTINEL_TS - dt.timedelta(days=1))
    assert got == _rows(want, ["window_end", "rank", "k", "cnt"])


def test_unique_visitors_twin(spark, events, stream):
    got = run_available(stream_unique_visitors(stream().where("event_type = 'view'"), "ts", "user_id", "1 hour",
                                               delay=DELAY), _name("uv"))
    want = unique_visitors(events.where("event_type = 'view'"), "ts", "user_id", "1 hour")
    cols = ["window_start", "window_end", "uv"]
    assert _rows(_before_sentinel(got, "window_end"), cols) == _rows(want, cols)


def test_interval_join_twin(spark, events, stream):
    def sides(ev):
        pays = ev.where("event_type = 'view'").select("user_id", F.col("event_id").alias("pay_id"),
                                                      F.col("ts").alias("pay_ts"))
        recs = ev.where("event_type = 'click'").select("user_id", F.col("event_id").alias("rec_id"),
                                                       F.col("ts").alias("rec_ts"))
        return pays, recs
    s = stream()
    got = run_available(stream_interval_join(*sides(s), "user_id", "pay_ts", "rec_ts", -3 * 3600, 5 * 3600,
                                             delay=DELAY), _name("ij"))
    want = interval_join(*sides(events), "user_id", "pay_ts", "rec_ts", -3 * 3600, 5 * 3600)
    cols = ["user_id", "pay_id", "rec_id"]
    assert _rows(got.where("user_id < 1000000"), cols) == _rows(want, cols)


def test_payment_timeout_twin(spark, events, stream):
    use_rocksdb(spark)
    s = stream()
    got = run_available(stream_payment_timeout(s.where("event_type = 'signup'"), s.where("event_type = 'purchase'"),
                                               "user_id", "ts", "24 hours", "event_id", delay=DELAY), _name("pay"))
    res = payment_timeout(events.where("event_type = 'signup'"), events.where("event_type = 'purchase'"),
                          "user_id", "ts", "24 hours")
    want = _rows(res.paid, ["event_id", "status"]) + _rows(res.timed_out, ["event_id", "status"])
    assert _rows(got.where("user_id < 1000000"), ["event_id", "status"]) == sorted(want)


def test_quota_twin(spark, events, stream):
    use_rocksdb(spark)
    got = run_available(stream_quota_filter(stream().select("event_id", "ts", "user_id"), ["user_id"], "ts",
                                            "event_id", max_count=3, delay=DELAY), _name("quota"))
    res = quota_filter(events.select("event_id", "ts", "user_id"), ["user_id"], "ts", "event_id", max_count=3)
    got = got.where("user_id < 1000000")
    assert _rows(got.where("status = 'pass'"), ["event_id"]) == _rows(res.passed, ["event_id"])
    assert _rows(got.where("status = 'warn'"), ["user_id", "day"]) == _rows(res.warnings, ["user_id", "day"])


def test_consecutive_twin(spark, events, stream):
    use_rocksdb(spark)
    fail = F.col("event_type") == "error"
    got = run_available(stream_consecutive(stream(), "user_id", "ts", "event_id", fail, "12 hours", delay=DELAY),
                        _name("cons"))
    want = consecutive(events, "user_id", "ts", "event_id", fail, "12 hours")
    cols = ["user_id", "first_ts", "last_ts"]
    assert _rows(got.where("user_id < 1000000"), cols) == _rows(want, cols)


def test_outer_match_twin(spark, tmp_path):
    t = dt.datetime(2024, 5, 1, 12, 0, 0)
    pays = [("m", t), ("late", t), ("p_only", t), ("zz", SENTINEL_TS)]
    recs = [("m", t + dt.timedelta(seconds=5)), ("late", t + dt.timedelta(seconds=6)), ("r_only", t),
            ("zz", SENTINEL_TS)]
    for name, rows in (("pays", pays), ("recs", recs)):
        spark.createDataFrame(rows, "tx string, ts timestamp_ntz").write.parquet(str(tmp_path / name))
    ls = spark.readStream.schema("tx string, ts timestamp_ntz").parquet(str(tmp_path / "pays"))
    rs = spark.readStream.schema("tx string, ts timestamp_ntz").parquet(str(tmp_path / "recs"))
    got = run_available(stream_outer_match(ls, rs, "tx", "ts", "ts", -3, 5), _name("om"))
    want = outer_match(spark.createDataFrame(pays, "tx string, ts timestamp_ntz"),
                       spark.createDataFrame(recs, "tx string, ts timestamp_ntz"), "tx", "ts", "ts", -3, 5)
    assert _rows(got.where("tx != 'zz'"), ["tx", "status"]) == _rows(want.where("tx != 'zz'"), ["tx", "status"])


@pytest.mark.parametrize("rule", ["blocks", "threshold", "follow", "chain", "span"])
def test_sequence_twins(spark, events, stream, rule):
    from clickstream.operators.sequence import blocks, follow_distinct, threshold_then_next
    from clickstream.streaming import stream_sequence
    use_rocksdb(spark)
    signup = F.col("event_type") == "signup"
    if rule == "blocks":
        s = stream_sequence(stream(), "user_id", "ts", "event_id", "blocks", "36 hours", n=6, delay=DELAY)
        want = blocks(events, "user_id", "ts", "event_id", 6, "36 hours")
        cols = ["user_id", "first_ts", "last_ts"]
    elif rule == "span":
        from clickstream.operators.sequence import n_in_span
        s = stream_sequence(stream(), "user_id", "ts", "event_id", "span", "6 hours", n=3, delay=DELAY)
        want = n_in_span(events, "user_id", "ts", "event_id", 3, "6 hours")
        cols = ["user_id", "first_ts", "last_ts"]
    elif rule == "threshold":
        s = stream_sequence(stream(), "user_id", "ts", "event_id", "threshold", "10 hours", threshold=100,
                            value="value", delay=DELAY)
        want = threshold_then_next(events, "user_id", "ts", "event_id", "value", 100, "10 hours") \
            .withColumnRenamed("next_ts", "last_ts")
        cols = ["user_id", "first_ts", "last_ts"]
    else:
        chain = rule == "chain"
        # sf0.001 has few signups per item: two followers within 15 days
        s = stream_sequence(stream(), "k", "ts", "event_id", "follow", "15 days", n=2, who="user_id", chain=chain,
                            cond=signup, delay=DELAY)
        want = follow_distinct(events, "k", "ts", "event_id", "user_id", 2, "15 days", chain=chain, cond=signup)
        cols = ["k", "start_user_id", "first_ts", "last_ts"]
    got = run_available(s, _name(f"seq_{rule}"))
    got = _before_sentinel(got, "first_ts")
    assert _rows(got, cols) == _rows(want, cols)
    assert len(_rows(want, cols)) > 0


def test_burst_twin(spark, events, stream):
    from clickstream.operators.sequence import burst
    from clickstream.streaming import stream_burst
    use_rocksdb(spark)
    fail = F.col("event_type") == "error"
    got = run_available(stream_burst(stream(), "user_id", "ts", "event_id", fail, 2, "24 hours", delay=DELAY),
                        _name("burst"))
    want = burst(events, "user_id", "ts", "event_id", fail, 2, "24 hours")
    cols = ["user_id", "first_ts", "last_ts", "times"]
    assert _rows(_before_sentinel(got, "first_ts"), cols) == _rows(want, cols)
    assert len(_rows(want, cols)) > 0


def test_processing_time_windows_on_a_stream(spark, events, stream, stream_dir):
    from clickstream.streaming import stream_processing_time_count
    # a micro-batch (one file) has one ingest time; its window comes out once later batches move the clock past it
    got = run_available(stream_processing_time_count(stream(), "1 second"), _name("pt")).collect()
    per_file = [r["count"] for r in spark.read.schema(events.schema).option("recursiveFileLookup", "true").parquet(stream_dir)
                .groupBy(F.input_file_name()).count().collect()]
    assert got and all(r.window_end - r.window_start == dt.timedelta(seconds=1) for r in got)
    sums = {0}
    for n in per_file:  # quick batches may share a second
        sums |= {x + n for x in sums}
    assert all(r.cnt in sums for r in got) and sum(r.cnt for r in got) <= sum(per_file)


def test_lateness_counts_late_rows(spark, events, stream):
    # with no delay rows shuffled inside a file are still kept by lateness alone
    got = run_available(stream_window_count(stream().where("event_type = 'view'"), "ts", "1 hour", "1 hour",
                                            delay="0 seconds", lateness=DELAY), _name("late"))
    want = window_count(events.where("event_type = 'view'"), "ts", "1 hour")
    cols = ["window_end", "cnt"]
    assert _rows(_before_sentinel(got, "window_end"), cols) == _rows(want, cols)


def test_log_stream_reads_files(spark, tmp_path):
    from clickstream.sources.files import read_log_stream, split_corrupt
    (tmp_path / "a.csv").write_text("1,83.1.1.1,fail,1558430842\n2,83.1.1.2,success,1558430843\n")
    (tmp_path / "b.csv").write_text("3,83.1.1.3,fail,1558430844\nbroken\n")
    good, bad = split_corrupt(read_log_stream(spark, str(tmp_path), "login", max_files_per_trigger=1))
    assert sorted(r.user_id for r in run_available(good, _name("log")).collect()) == [1, 2, 3]
    assert run_available(bad, _name("log")).count() == 1


def test_split_to_sinks_reads_once(spark, stream, stream_dir, events):
    from clickstream.streaming import split_to_sinks
    got = {"error": 0, "view": 0, "others": 0}

    def sink(label):
        def run(df, _):
            got[label] += df.count()
        return run
    run_available(stream(), _name("split"), foreach_batch=split_to_sinks({k: sink(k) for k in ("error", "view")}, col="event_type", rest=sink("others")))
    want = {r.event_type: r["count"] for r in spark.read.schema(events.schema).option("recursiveFileLookup", "true").parquet(stream_dir).groupBy("event_type").count().collect()}
    assert got == {"error": want["error"], "view": want["view"], "others": sum(want.values()) - want["error"] - want["view"]}


def test_idle_state_is_cleared():
    """Processors drop a key's state once nothing in it can matter (plain objects in place of the state store)."""
    from clickstream.streaming.stateful import ConsecutiveProcessor, PaymentProcessor, SequenceProcessor

    class State:
        def __init__(self):
            self.v = None
        def get(self):
            return self.v or []
        def put(self, v):
            self.v = list(v)
        def update(self, v):
            self.v = v
        def exists(self):
            return self.v is not None
        def clear(self):
            self.v = None

    class Map(State):
        def iterator(self):
            return iter(list((self.v or {}).items()))

    class Handle:
        def __init__(self):
            self.states, self.timers = {}, []
        def getListState(self, name, _):
            return self.states.setdefault(name, State())
        def getMapState(self, name, *_):
            return self.states.setdefault(name, Map())
        getValueState = getListState
        def registerTimer(self, ms):
            self.timers.append(ms)
        def deleteTimer(self, ms):
            self.timers.remove(ms)

    class At:
        def __init__(self, ms):
            self.ms = ms
        def getCurrentWatermarkInMs(self):
            return self.ms

    sec = 1_000_000
    cases = [(ConsecutiveProcessor(["k"], 2, 5 * sec), [(10 * sec, 1, True)]),
             (SequenceProcessor(["k"], "blocks", 5 * sec, n=3), [(10 * sec, 1, None, None)]),
             (SequenceProcessor(["k"], "follow", 5 * sec, n=2), [(10 * sec, 1, None, "a")]),
             (PaymentProcessor(["k"], 5 * sec), [(10 * sec, "7", False)])]
    for proc, rows in cases:
        h = Handle()
        proc.init(h)
        proc.release(("x",), rows, At(11_000))
        assert h.timers == [15_000] and any(s.v for n, s in h.states.items() if n != "timer")
        out = list(proc.handleExpiredTimer(("x",), At(15_000), None))
        assert not any(s.v for s in h.states.values())
        assert [list(r.status) for r in out] == ([["timeout"]] if isinstance(proc, PaymentProcessor) else [])


def test_running_visitors_twin(spark, events, stream):
    from clickstream.operators.visitors import running_visitors
    from clickstream.streaming import stream_running_visitors
    use_rocksdb(spark)
    views = stream().where("event_type = 'view'")
    got = run_available(stream_running_visitors(views, "ts", "user_id", "event_id", "1 hour", delay=DELAY),
                        _name("ruv"))
    want = running_visitors(events.where("event_type = 'view'"), "ts", "user_id", "event_id", "1 hour")
    cols = ["window_end", "user_id", "uv_so_far"]
    assert _rows(_before_sentinel(got, "window_end"), cols) == _rows(want, cols)


class _Value:
    def __init__(self):
        self.v = None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v

    def exists(self):
        return self.v is not None

    def clear(self):
        self.v = None


class _List(_Value):
    def get(self):
        return self.v or []

    put = _Value.update


class _Map:
    def __init__(self):
        self.v, self.read = {}, 0

    def containsKey(self, k):
        return k in self.v

    def getValue(self, k):
        self.read += 1
        return self.v[k]

    def updateValue(self, k, v):
        self.v[k] = v

    def removeKey(self, k):
        del self.v[k]

    def iterator(self):
        return iter(list(self.v.items()))


class _Store:
    """Plain objects in place of the state store."""

    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, *_):
        return self.states.setdefault(name, _Value())

    def getListState(self, name, *_):
        return self.states.setdefault(name, _List())

    def getMapState(self, name, *_):
        return self.states.setdefault(name, _Map())

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)

    def fire(self, proc, key, wm_ms):
        """What the timers up to a watermark release."""
        at, out = _At(wm_ms), []
        while due := [t for t in self.timers if t <= wm_ms]:
            self.timers -= set(due)
            out += [r for f in proc.handleExpiredTimer(key, at, None) for r in f.itertuples(index=False, name=None)]
        return out

    def rows(self):
        return sum(len(v[0]) for v in self.states["parts"].v.values())


class _At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_quota_state_does_not_grow_with_a_bot():
    import pandas as pd
    from clickstream.streaming.stateful import QuotaProcessor
    rnd = random.Random(4)
    rows = [(rnd.randrange(3600 * 10**6), i) for i in range(20_000)]
    proc, store = QuotaProcessor(["k"], 50), _Store()
    proc.init(store)
    got, most = [], 0
    for a in range(0, len(rows), 500):  # all clicks of an hour, in any order, before the watermark passes any
        proc.handleInputRows(("bot", 0), iter([pd.DataFrame(rows[a:a + 500], columns=["cs_us", "seq"])]), _At(0))
        most = max(most, store.rows())
    assert most <= 102
    first = sorted(rows)[:51]
    half = first[20][0] // 1000 + 1
    got += store.fire(proc, ("bot", 0), half)
    got += store.fire(proc, ("bot", 0), 3_600_000)
    assert [(r[2], r[3]) for r in got] == first and [r[4] for r in got] == ["pass"] * 50 + ["warn"]
    late = pd.DataFrame([(3600 * 10**6 + i, 10**6 + i) for i in range(1000)], columns=["cs_us", "seq"])
    proc.handleInputRows(("bot", 0), iter([late]), _At(3_600_000))
    assert store.rows() == 0  # the warning is out
    assert store.fire(proc, ("bot", 0), 86_400_000) == []
    assert not store.states["count"].exists() and not store.timers and not store.states["index"].v


def test_release_reads_only_the_buckets_reached():
    import pandas as pd
    from clickstream.streaming.stateful import ConsecutiveProcessor
    proc, store = ConsecutiveProcessor(["k"], 2, 10**6), _Store()
    proc.init(store)
    minute = 60_000_000
    rows = pd.DataFrame([(m * minute + s * 10**6, 60 * m + s, False) for m in range(100) for s in range(60)],
                        columns=["cs_us", "seq", "cs_ok"])
    proc.handleInputRows(("x",), iter([rows]), _At(0))
    store.states["parts"].read = 0
    store.fire(proc, ("x",), 30_000)
    assert store.states["parts"].read == 1 and store.rows() == 6000 - 31
    store.fire(proc, ("x",), 100 * 60_000 + 60_000)
    assert not store.states["index"].v and not store.states["parts"].v and not store.timers


@pytest.mark.parametrize("seed", [1, 2])
def test_one_slot_twin(spark, tmp_path, seed):
    from clickstream.operators.matching import one_slot_match
    from clickstream.streaming import stream_one_slot_match
    use_rocksdb(spark)
    rnd = random.Random(seed)
    base = dt.datetime(2024, 5, 1)
    rows = [(rnd.choice(["a", "b", "hot", "hot"]), base + dt.timedelta(seconds=rnd.randrange(600)), rnd.random() < 0.5, i)
            for i in range(300)]
    rows += [(None, base, True, 900), ("a", None, False, 901)]
    schema = "tx string, ts timestamp_ntz, seq long"
    done = SENTINEL_TS

    def side(left):
        d = tmp_path / str(left)
        mine = sorted(((k, t, i) for k, t, x, i in rows if x == left), key=lambda r: (r[1] or base))
        for n in range(4):
            part = mine[n * len(mine) // 4:(n + 1) * len(mine) // 4]
            rnd.shuffle(part)
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(d / f"p{n}"))
        spark.createDataFrame([("zz", done, 10**6)], schema).coalesce(1).write.parquet(str(d / "p9"))
        return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
                .parquet(str(d)))

    got = run_available(stream_one_slot_match(side(True), side(False), "tx", "ts", "ts", "seq", "-3 seconds", "5 seconds",
                                              delay="10 minutes"), _name("slot"))
    frame = lambda left: spark.createDataFrame([(k, t, i) for k, t, x, i in rows if x == left], schema)
    want = one_slot_match(frame(True), frame(False), "tx", "ts", "ts", "seq", "-3 seconds", "5 seconds")
    cols = ["tx", "status", "left_seq", "right_seq"]
    have = sorted((tuple(r[c] for c in cols) for r in got.where("tx is null or tx != 'zz'").collect()), key=str)
    assert have == sorted((tuple(r[c] for c in cols) for r in want.collect()), key=str)
    assert sum(r[1] == "matched" for r in have) > 30


def test_early_on_time_and_late_firings(spark, tmp_path):
    from clickstream.streaming import firings, latest, read_versions, stream_window_changes, write_versions
    base = dt.datetime(2024, 5, 1, 12)
    m = lambda x: base + dt.timedelta(minutes=x)
    batches = [[1, 2], [4, 8], [11, 21], [3, 22], [38, 39], [40], [5, 41]]  # minutes; windows of 10, delay 1, lateness 20
    d = tmp_path / "in"
    for n, part in enumerate(batches):
        spark.createDataFrame([("a", m(x)) for x in part], "k string, ts timestamp_ntz").coalesce(1).write.parquet(str(d / f"p{n}"))
    src = (spark.readStream.schema("k string, ts timestamp_ntz").option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(str(d)))
    changes = stream_window_changes(src, "ts", "10 minutes", keys="k", delay="1 minute", lateness="20 minutes")
    path = str(tmp_path / "out")
    write = write_versions(path)
    twice = lambda df, n: (write(df, n), write(df, n))  # noqa: E731  a micro-batch repeated after a failure
    run_available(changes, _name("fire"), foreach_batch=twice, mode="update")
    versions = read_versions(spark, path, changes.schema)
    minute = lambda t: int((t - base).total_seconds() // 60)
    got = sorted((minute(r.window_end), r.batch, r.cnt, r.firing) for r in firings(versions, "k", "1 minute").collect())
    # minute 5 comes when the watermark is at 38, more than 20 past its window's end: dropped
    assert got == [(10, 0, 2, "early"), (10, 1, 4, "on_time"), (10, 3, 5, "late"),
                   (20, 2, 1, "on_time"), (30, 2, 1, "early"), (30, 3, 2, "on_time"),
                   (40, 4, 2, "on_time"), (50, 5, 1, "early"), (50, 6, 2, "early")]
    state = sorted((minute(r.window_end), r.cnt) for r in latest(versions, "k").collect())
    assert state == [(10, 5), (20, 1), (30, 2), (40, 2), (50, 2)]
    assert firings(versions.where("false"), "k", "1 minute").count() == 0 and latest(versions.where("false"), "k").count() == 0
