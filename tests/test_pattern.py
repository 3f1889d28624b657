"""The general pattern operator: against a plain matcher, and the fixed rules expressed through it."""

import datetime as dt
import operator
import random

import pytest
from pyspark.sql import functions as F

import helpers as H
from clickstream.operators.matching import payment_timeout
from clickstream.operators.pattern import PREVIOUS, Step, match_sequence
from clickstream.operators.sequence import trailing_sum

SCHEMA = "user long, ts timestamp_ntz, seq long, kind string, value double, who long"
OP = {"==": operator.eq, "!=": operator.ne, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}


def make(seed, n=300, users=3, horizon=1500):
    rnd = random.Random(seed)
    return [{"user": rnd.choice([*range(users - 1), None]), "ts": H.ts(rnd.randrange(horizon)), "seq": i,
             "kind": rnd.choice(["a", "b", "c", None]), "value": rnd.choice([None, 0.5, *map(float, range(8))]),
             "who": rnd.choice([0, 1, 2, None])} for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)


def plain(rows, steps, within, key="user"):
    """(key, {step: [events taken]}, status) of every start, one event at a time; ``steps``: (name, cond, contiguity, times, where, optional)."""
    w, out = dt.timedelta(seconds=within), []
    groups = {}
    for r in sorted(rows, key=lambda r: (r["ts"], r["seq"])):
        groups.setdefault(r[key] if key else None, []).append(r)

    def holds(e, where, got, last):
        for col, op, other, col2 in where:
            if other != PREVIOUS and not got.get(other):
                continue
            x, y = e[col], (last if other == PREVIOUS else got[other][-1])[col2]
            if op in ("==", "!="):
                good = (x == y) == (op == "==")
            else:
                good = x is not None and y is not None and OP[op](x, y)
            if not good:
                return False
        return True

    def reach(ev, i, step, got, times):
        """(indexes, stopped) of ``times`` events after index i"""
        _, cond, contiguity, _, where, _ = step
        taken = []
        for _ in range(times):
            if contiguity == "next":
                j = i + 1
                if j >= len(ev):
                    return None, False
                if not (cond(ev[j]) and holds(ev[j], where, got, ev[i])):
                    return None, True
            else:
                j = next((j for j in range(i + 1, len(ev)) if cond(ev[j]) and holds(ev[j], where, got, ev[i])), None)
                if j is None:
                    return None, False
            taken.append(j)
            i = j
        return taken, False

    for k, ev in groups.items():
        for s, e in enumerate(ev):
            if not steps[0][1](e):
                continue
            got, i, status = {steps[0][0]: [e]}, s, "match"
            for n, step in enumerate(steps):
                times = step[3] - (n == 0)
                if not times:
                    continue
                at, stopped = reach(ev, i, step, got, times)
                good = at is not None and ev[at[-1]]["ts"] - e["ts"] < w
                if step[5]:
                    after, _ = reach(ev, i, steps[n + 1], got, 1)
                    if not good or (after is not None and after[0] <= at[-1]):
                        continue
                if not good:
                    failed_at = i + 1
                    if stopped and step[2] == "next":
                        # the failing neighbour of the last event taken in this step
                        chain, j = [], i
                        while True:
                            nxt, _ = reach(ev, j, step, got, 1)
                            if nxt is None:
                                break
                            j = nxt[0]
                        failed_at = j + 1
                        status = "ended" if ev[min(failed_at, len(ev) - 1)]["ts"] - e["ts"] < w else "timeout"
                    else:
                        status = "timeout"
                    break
                got.setdefault(step[0], []).extend(ev[j] for j in at)
                i = at[-1]
            out.append((k, got, status))
    return out


def compare(spark, rows, steps, within, key="user", chunk=None, timeout=False):
    df = frame(spark, rows)
    col = {"any": None, "a": F.col("kind") == "a", "b": F.col("kind") == "b", "c": F.col("kind") == "c", "big": F.col("value") > 3}
    fn = {"any": lambda e: True, "a": lambda e: e["kind"] == "a", "b": lambda e: e["kind"] == "b", "c": lambda e: e["kind"] == "c",
          "big": lambda e: e["value"] is not None and e["value"] > 3}
    own = [Step(n, col[c], cont, times, where, opt) for n, c, cont, times, where, opt in steps]
    select = {f"{n}_{w}": (n, "seq", w) for n, *_ in steps for w in ("first", "last")}
    got = match_sequence(df, key, "ts", "seq", own, within, select, timeout=timeout, chunk=chunk).collect()
    got = sorted(((r[key] if key else None, *[r[c] for c in select], r.status if timeout else "match") for r in got), key=str)
    want = []
    for k, taken, status in plain(rows, [(n, fn[c], cont, t, w, o) for n, c, cont, t, w, o in steps], within, key):
        if status == "match" or (timeout and status == "timeout"):
            want.append((k, *[(taken[n][0 if w == "first" else -1]["seq"] if taken.get(n) else None) for n, *_ in steps
                              for w in ("first", "last")], status))
    assert got == sorted(want, key=str)
    return len(want)


PATTERNS = [
    [("s", "a", "follow", 1, (), False), ("t", "b", "follow", 1, (), False), ("u", "c", "follow", 1, (), False)],
    [("s", "a", "follow", 1, (), False), ("t", "any", "next", 1, (), False), ("u", "b", "next", 1, (("who", "!=", "s", "who"),), False)],
    [("s", "any", "follow", 1, (), False), ("t", "any", "follow", 3, (("who", "!=", PREVIOUS, "who"),), False)],
    [("s", "any", "follow", 1, (), False), ("t", "any", "follow", 3, (("who", "!=", "s", "who"),), False)],
    [("s", "a", "follow", 1, (), False), ("t", "any", "follow", 2, (("who", "==", "s", "who"),), False), ("u", "c", "follow", 1, (), False)],
    [("s", "a", "follow", 1, (), False), ("t", "b", "follow", 1, (("value", ">", "s", "value"),), False),
     ("u", "any", "follow", 2, (("value", ">=", PREVIOUS, "value"),), False)],
    [("s", "any", "follow", 2, (("value", "<", PREVIOUS, "value"),), False), ("u", "c", "follow", 1, (("value", "<=", "s", "value"),), False)],
    [("s", "a", "follow", 1, (), False), ("o", "b", "follow", 1, (), True), ("u", "c", "follow", 1, (("who", "!=", "o", "who"),), False)],
    [("s", "a", "follow", 1, (), False), ("t", "any", "follow", 1, (("who", "!=", "s", "who"), ("value", ">", "s", "value")), False)],
    [("s", "big", "follow", 4, (), False)],
]


@pytest.mark.parametrize("number", range(len(PATTERNS)))
def test_patterns_match_plain_walk(spark, number):
    n = compare(spark, make(number), PATTERNS[number], 60, chunk=None if number % 2 else 61)
    n += compare(spark, make(50 + number, 150), PATTERNS[number], 200, key=None if number % 3 else "user")
    assert n > 5


@pytest.mark.parametrize("number", [0, 2, 5, 7])
def test_timeouts(spark, number):
    assert compare(spark, make(number, 200), PATTERNS[number], 40, timeout=True) > 20


def test_next_steps_end_or_time_out(spark):
    rows = [dict(user=1, ts=H.ts(s), seq=i, kind=k, value=1.0, who=0) for i, (s, k) in enumerate([(0, "a"), (1, "c"), (100, "a"), (200, "b")])]
    steps = [Step("s", F.col("kind") == "a"), Step("t", F.col("kind") == "b", "next")]
    got = match_sequence(frame(spark, rows), "user", "ts", "seq", steps, 50, {"s": ("s", "seq"), "t": ("t", "seq")}, timeout=True)
    assert [tuple(r) for r in got.collect()] == [(1, 2, None, "timeout")]  # seq 0 was ended by the c


def tuples(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_fixed_rules_through_patterns(spark):
    rows = [r for r in make(77, 400, 4, 2500) if r["user"] is not None and r["who"] is not None and r["value"] is not None]
    df = frame(spark, rows)
    a = F.col("kind") == "a"
    is_a = lambda e: e["kind"] == "a"
    W = dt.timedelta(seconds=40)
    run = lambda steps, **o: tuples(match_sequence(df, "user", "ts", "seq", steps, 40, **o), ["user", "first_ts", "last_ts"])
    assert run([Step("x", a), Step("y", a, "next")]) == sorted(H.consecutive(rows, "user", is_a, 2, W), key=str)           # I1
    assert run([Step("x", times=3)]) == sorted(H.n_in_span(rows, "user", 3, W), key=str)                                   # I2
    assert run([Step("x", times=4)], skip="past_last") == sorted(H.blocks(rows, "user", 4, W), key=str)                    # I3
    assert run([Step("x", F.col("value") > 4), Step("y", contiguity="next")], skip="past_last") == sorted(
        H.threshold_then_next(rows, "user", "value", 4, W), key=str)                                                       # I4
    sums = trailing_sum(df, "user", "ts", "seq", "value", 40)
    got = match_sequence(sums, "user", "ts", "seq", [Step("x", F.col("trailing") > 9), Step("y", contiguity="next")], 40, skip="past_last")
    from clickstream.operators.sequence import threshold_then_next
    assert tuples(got, ["user", "first_ts", "last_ts"]) == tuples(
        threshold_then_next(df, "user", "ts", "seq", "value", 9, 40, mode="cumulative"), ["user", "first_ts", "next_ts"])
    for other in ("x", PREVIOUS):                                                                                          # I5, I6
        got = match_sequence(df, "user", "ts", "seq", [Step("x"), Step("y", times=3, where=[("who", "!=", other, "who")])], 40,
                             {"start_who": ("x", "who"), "first_ts": ("x", "ts"), "last_ts": ("y", "ts")}, skip="past_last", chunk=40)
        assert tuples(got, ["user", "start_who", "first_ts", "last_ts"]) == sorted(
            H.follow_distinct(rows, "user", "who", 3, W, other == PREVIOUS), key=str)
    pay = payment_timeout(df.where("kind = 'a'"), df.where("kind = 'b'"), "user", "ts", 40, keep=("seq",))                 # I7
    ordered = df.withColumn("seq2", F.when(F.col("kind") == "b", F.col("seq") + 1000).otherwise(F.col("seq")))  # a pay of the same time is after
    got = match_sequence(ordered, "user", "ts", "seq2", [Step("create", a), Step("pay", F.col("kind") == "b")], 40,
                         {"seq": ("create", "seq"), "pay_ts": ("pay", "ts")}, timeout=True)
    assert tuples(got.where("status = 'match'"), ["user", "seq", "pay_ts"]) == tuples(pay.paid, ["user", "seq", "pay_ts"])
    assert tuples(got.where("status = 'timeout'"), ["user", "seq"]) == tuples(pay.timed_out, ["user", "seq"])


def test_hot_key_is_spread_over_chunks(spark):
    rows = [{"user": 7, "ts": H.ts(i * 2), "seq": i, "kind": "abc"[i % 3], "value": float(i % 5), "who": i % 2} for i in range(900)]
    steps = [("s", "a", "follow", 1, (), False), ("t", "b", "follow", 2, (("value", ">", "s", "value"),), False)]
    assert compare(spark, rows, steps, 30, chunk=30) > 50
    assert frame(spark, rows).where("ts is null").count() == 0


def test_bad_patterns_and_empty_input(spark):
    df = frame(spark, make(1, 20))
    for steps in ([], [Step("a"), Step("a")], [Step("a"), Step("b", contiguity="any")], [Step("a"), Step("b", where=[("who", "~", "a", "who")])],
                  [Step("a"), Step("b", where=[("who", "==", "c", "who")])], [Step("a"), Step("b", optional=True)], [Step("previous")]):
        with pytest.raises((ValueError, IndexError)):
            match_sequence(df, "user", "ts", "seq", steps, 10)
    with pytest.raises(ValueError):
        match_sequence(df, "user", "ts", "seq", [Step("a")], 10, skip="past_last", timeout=True)
    assert match_sequence(df.where("false"), "user", "ts", "seq", [Step("a"), Step("b")], 10).count() == 0
