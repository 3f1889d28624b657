"""Brute-force reference implementations of the pattern rules (plain Python).

They simulate partial matches one event at a time, as the pattern library
does, and share no code with the Spark operators.
"""

from __future__ import annotations

import datetime as dt

#: The smallest of the given table folders.
SF_SMALL = "/root/testdata/sf0.001"

T0 = dt.datetime(2024, 1, 1)


def ts(sec: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=sec)


def by_key(rows, key):
    out = {}
    for r in sorted(rows, key=lambda r: (r["ts"], r["seq"])):
        out.setdefault(r[key], []).append(r)
    return out


def consecutive(rows, key, cond, n, w):
    res = []
    for k, ev in by_key(rows, key).items():
        for i in range(len(ev) - n + 1):
            run = ev[i:i + n]
            if all(cond(e) for e in run) and run[-1]["ts"] - run[0]["ts"] < w:
                res.append((k, run[0]["ts"], run[-1]["ts"]))
    return sorted(res)


def n_in_span(rows, key, n, w, cond=lambda e: True):
    return consecutive([r for r in rows if cond(r)], key, lambda e: True, n, w)


def _simulate(ev, starts_at, advance, done, w):
    """Skip-past-last-event NFA: returns (start_index, end_index) per emitted match."""
    partial = []  # [start_idx, state]
    out = []
    for j, e in enumerate(ev):
        partial = [p for p in partial if e["ts"] - ev[p[0]]["ts"] < w]
        completed = []
        nxt = []
        for s, st in partial:
            st2 = advance(ev, s, st, j)
            if done(st2):
                completed.append(s)
            else:
                nxt.append([s, st2])
        partial = nxt
        if starts_at(ev, j):
            st0 = advance(ev, j, None, j)
            if done(st0):
                completed.append(j)
            else:
                partial.append([j, st0])
        if completed:
            s = min(completed)
            out.append((s, j))
            partial = [p for p in partial if p[0] > j]
    return out


def blocks(rows, key, n, w):
    res = []
    for k, ev in by_key(rows, key).items():
        def adv(ev, s, st, j):
            return 1 if st is None else st + 1
        for s, j in _simulate(ev, lambda ev, j: True, adv, lambda st: st == n, w):
            res.append((k, ev[s]["ts"], ev[j]["ts"]))
    return sorted(res)


def threshold_then_next(rows, key, value, thr, w):
    res = []
    for k, ev in by_key(rows, key).items():
        def adv(ev, s, st, j):
            if st is None:
                return 0
            return 1 if j == s + 1 else -1  # strict next: only the adjacent event
        partial, out = [], []
        for j, e in enumerate(ev):
            partial = [s for s in partial if e["ts"] - ev[s]["ts"] < w and j == s + 1]
            if partial:
                s = min(partial)
                out.append((s, j))
                partial = []
                continue  # a start at j is pruned too (it started at the match's last event)
            if e[value] > thr:
                partial.append(j)
        for s, j in out:
            res.append((k, ev[s]["ts"], ev[j]["ts"]))
    return sorted(res)


def burst(rows, key, is_fail, min_count, span):
    res = []
    for k, ev in by_key(rows, key).items():
        group = []
        for e in ev:
            if not is_fail(e):
                if len(group) >= min_count:
                    res.append((k, group[0]["ts"], group[-1]["ts"], len(group)))
                group = []
                continue
            if group and e["ts"] <= group[0]["ts"] + span:
                group.append(e)
            else:
                if len(group) >= min_count:
                    res.append((k, group[0]["ts"], group[-1]["ts"], len(group)))
                group = [e]
        if len(group) >= min_count:
            res.append((k, group[0]["ts"], group[-1]["ts"], len(group)))
    return sorted(res)


def follow_distinct(rows, key, who, n_more, w, chain, cond=lambda e: True):
    res = []
    rows = [r for r in rows if cond(r)]
    for k, ev in by_key(rows, key).items():
        def adv(ev, s, st, j):
            if st is None:
                return (ev[s][who], 0)
            ref, got = st
            if ev[j][who] != ref:
                return (ev[j][who] if chain else ref, got + 1)
            return st
        for s, j in _simulate(ev, lambda ev, j: True, adv, lambda st: st[1] == n_more, w):
            res.append((k, ev[s][who], ev[s]["ts"], ev[j]["ts"]))
    return sorted(res)


def sliding_counts(rows, key, size, slide):
    """{(key, window_end): count} by direct window membership (windows [start, end))."""
    out = {}
    for r in rows:
        t = (r["ts"] - T0).total_seconds() + (T0 - dt.datetime(1970, 1, 1)).total_seconds()
        first_end = (int(t // slide) + 1) * slide
        e = first_end
        while e - size <= t:
            if t < e:
                out[(r[key], e)] = out.get((r[key], e), 0) + 1
            e += slide
    return out
