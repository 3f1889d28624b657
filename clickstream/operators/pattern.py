"""General event patterns: steps, contiguity, repeats, captured events, timeouts.

A pattern is a list of :class:`Step`.  Per key and in ``(ts, seq)`` order, every event that
meets the first step's condition starts a match, and each later step takes the first event
after the last one taken that fits (``follow``: events in between are skipped; ``next``: the
very next event must fit, or the match ends).  The last event lies less than ``within`` after
the first.  A step can compare an event with events taken before (``where``).

*Plan.*  A key's time line is cut into chunks with a halo (as in
:mod:`clickstream.operators.sequence`), so a match that starts in a chunk sees all its events
there and a hot key is spread over its chunks.  Each task gets whole chunks in order and
matches all starts of all its chunks at once with arrays:

* the first event after a position that meets a step's condition is a search in the sorted
  positions of that step's events (its *next-match pointers*);
* "differs from a taken event" jumps to the end of a run of equal values, "equals" searches
  (value, position) pairs, and greater / less walk a table of maxima over blocks of
  1, 2, 4, ... events, from large blocks to small;
* ``times`` repeats against the event before are powers of the pointer array, by doubling.

The work is n log n per chunk and does not depend on how far apart a match's events are.
``skip="past_last"`` passes the matches to :func:`~clickstream.operators.sequence.greedy_select`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickstream.functions.eventtime import duration_us, epoch_us
from clickstream.operators.sequence import _chunk_us, greedy_select, with_halo
from clickstream.operators.sorted_groups import group_starts, scan_sorted_groups

#: Comparisons of ``Step.where``; NULL equals NULL and differs from values, and is neither greater nor less.
OPS = ("==", "!=", ">", ">=", "<", "<=")
#: Names the event taken last before the one in question.
PREVIOUS = "previous"


@dataclass(frozen=True)
class Step:
    """One step of a pattern.

    ``cond``: condition on the event alone (None: any event; NULL is false).
    ``contiguity``: ``"follow"`` or ``"next"``; of the first step it only rules its repeats.
    ``times``: number of events the step takes, each under the same rules.
    ``where``: ``(column, op, step, column of that step)`` comparisons with the (last) event
    taken by an earlier step, or with :data:`PREVIOUS`; all must hold.  A comparison with a
    skipped optional step holds.
    ``optional``: the step is taken only if its (last) event comes before the event that the
    following step would take without it.
    """

    name: str
    cond: Column | None = None
    contiguity: str = "follow"
    times: int = 1
    where: Sequence[tuple[str, str, str, str]] = ()
    optional: bool = False


def _check(steps: Sequence[Step], select, columns) -> None:
    names = [s.name for s in steps]
    if not steps or len(set(names)) != len(names) or PREVIOUS in names:
        raise ValueError("steps need distinct names other than 'previous'")
    for k, s in enumerate(steps):
        if s.contiguity not in ("follow", "next") or s.times < 1:
            raise ValueError(f"step {s.name}: contiguity is 'follow' or 'next', times at least 1")
        if s.optional and (k == 0 or k == len(steps) - 1 or steps[k + 1].optional):
            raise ValueError(f"step {s.name}: an optional step needs a step before it and a required one after it")
        for col, op, other, col2 in s.where:
            if op not in OPS or other not in (PREVIOUS, *names[:k]) or col not in columns or col2 not in columns:
                raise ValueError(f"step {s.name}: bad comparison {(col, op, other, col2)}")
            if k == 0 and s.times == 1:
                raise ValueError("the first event has nothing to be compared with")
    for out in select.values():
        if out[0] not in names or out[1] not in columns or (len(out) > 2 and out[2] not in ("first", "last")):
            raise ValueError(f"bad selection {out}")


def match_sequence(df: DataFrame, keys, ts: str, seq: str, steps: Sequence[Step], within,
                   select: dict[str, tuple] | None = None, skip: str = "none", timeout: bool = False,
                   chunk=None) -> DataFrame:
    """Matches of a pattern: ``keys..., <selected columns>`` and, with ``timeout``, ``status``.

    ``select`` maps output names to ``(step, column)`` of the event the step took last, or
    ``(step, column, "first")`` of its first; by default ``first_ts`` and ``last_ts``.
    ``skip="none"``: every start may match, matches overlap.  ``skip="past_last"``: a match
    discards the partial matches that started at or before its last event.
    ``timeout=True`` (with ``skip="none"``) adds the starts whose time ran out: ``status`` is
    ``match`` or ``timeout``, and columns of steps not reached are NULL.  A start that a
    ``next`` step ended is neither.  Optional steps that were skipped are NULL too.

    Rows without a time are no events; NULL keys are a key like any other; ``keys=None`` is
    one sequence of all rows, still cut into chunks.
    """
    keys = [] if keys is None else [keys] if isinstance(keys, str) else list(keys)
    select = select or {"first_ts": (steps[0].name, ts, "first"), "last_ts": (steps[-1].name, ts)}
    _check(steps, select, df.columns)
    if skip not in ("none", "past_last") or (timeout and skip != "none"):
        raise ValueError("skip is 'none' or 'past_last'; timeouts need 'none'")
    span = duration_us(within)
    used = sorted({c for s in steps for w in s.where for c in (w[0], w[3])} | {x[1] for x in select.values()})
    name = {c: f"_v{i}" for i, c in enumerate(used)}
    own = {f"_key{i}": k for i, k in enumerate(keys)}
    base = df.where(F.col(ts).isNotNull()).select(
        (F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys])) if keys else F.lit("")).alias("_gk"),
        epoch_us(df, ts).alias("_us"), F.col(seq).cast("long").alias("_seq"),
        *[F.col(f"`{k}`").alias(a) for a, k in own.items()], *[F.col(f"`{c}`").alias(a) for c, a in name.items()],
        *[F.coalesce(s.cond if s.cond is not None else F.lit(True), F.lit(False)).alias(f"_c{k}") for k, s in enumerate(steps)])
    halo = with_halo(base, "_us", span, _chunk_us(span, chunk))
    plain = [(s.name, s.contiguity, s.times, tuple((name[a], op, other, name[b]) for a, op, other, b in s.where), s.optional)
             for s in steps]
    out = {f"_o{i}": (x[0], name[x[1]], x[2] if len(x) > 2 else "last") for i, x in enumerate(select.values())}
    long = T.LongType()
    schema = T.StructType([T.StructField(a, df.schema[k].dataType) for a, k in own.items()]
                          + [T.StructField(a, df.schema[x[1]].dataType) for a, x in zip(out, select.values())]
                          + [T.StructField("status", T.StringType())]
                          + [T.StructField(c, long) for c in ("s_us", "s_seq", "e_us", "e_seq")])

    def scan(table: pa.Table) -> pa.Table:
        return _scan(table, plain, span, list(own), out, timeout)

    found = scan_sorted_groups(halo, ["_gk", "_chunk"], ["_us", "_seq"], scan, schema)
    if skip == "past_last":
        found = greedy_select(found, list(own), span, chunk)
    return found.select(*[F.col(a).alias(k) for a, k in own.items()], *[F.col(a).alias(n) for a, n in zip(out, select)],
                        *(["status"] if timeout else []))


class _Column:
    """A column of a table as codes (equal values and NULLs alike) and as comparable numbers."""

    def __init__(self, table: pa.Table, names: tuple[str, str]):
        both = pa.chunked_array([c for n in names for c in table[n].chunks]) if len(set(names)) > 1 else table[names[0]]
        coded = both.combine_chunks().dictionary_encode()
        code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        order = np.zeros(len(coded.dictionary) + 1, np.int64)  # values by rank; NULL is 0
        if len(coded.dictionary):
            order[1 + pc.array_sort_indices(coded.dictionary).to_numpy()] = np.arange(1, len(coded.dictionary) + 1)
        rank = order[code]
        n = table.num_rows
        self.left, self.right = rank[:n], rank[-n:] if n else rank


class _Finder:
    """First event after a position that fits a step."""

    def __init__(self, table: pa.Table, group: np.ndarray, cond: np.ndarray, step):
        _, self.contiguity, self.times, self.where, _ = step
        self.group, self.at, self.ok = group, np.flatnonzero(cond), cond
        self.n, self.size = len(group), len(self.at)
        self.values = [_Column(table, (a, b)) for a, _, _, b in self.where]
        self.jump = [self._tables(op, v.left[self.at]) for (_, op, _, _), v in zip(self.where, self.values)]

    def _tables(self, op: str, v: np.ndarray):
        if op == "!=":
            change = np.flatnonzero((v[1:] != v[:-1]) | (self.group[self.at][1:] != self.group[self.at][:-1])) + 1
            run_end = np.append(change, self.size)[np.searchsorted(change, np.arange(self.size), side="right")]
            return np.append(run_end, self.size)
        if op == "==":
            return np.sort(v * (self.size + 1) + np.arange(self.size))
        levels = [v if op[0] == ">" else np.where(v > 0, -v, np.iinfo(np.int64).min)]  # NULL is below all
        while 2 << (len(levels) - 1) <= self.size:
            half, k = levels[-1], 1 << (len(levels) - 1)
            levels.append(np.maximum(half[:-k], half[k:]))
        return levels

    def _first(self, k: int, i: np.ndarray, ref: np.ndarray) -> np.ndarray:
        """First index >= i among the step's events whose value compares with ``ref`` (rank 0: NULL)."""
        op, t = self.where[k][1], self.jump[k]
        v = np.append(self.values[k].left[self.at], -1)
        if op == "!=":
            return np.where(v[i] == ref, t[i], i)
        if op == "==":
            want = ref * (self.size + 1)
            pos = np.searchsorted(t, want + i)
            hit = np.append(t, -1)[pos]
            return np.where((pos < self.size) & (hit // (self.size + 1) == ref), hit % (self.size + 1), self.size)
        limit = ref if op[0] == ">" else -ref
        low = limit + (0 if op in (">=", "<=") else 1)  # the value must reach this
        i = i.copy()
        for level in range(len(t) - 1, -1, -1):  # leave out blocks whose maximum is too small
            for _ in range(2 if level == len(t) - 1 else 1):
                fits = i + (1 << level) <= self.size
                skip = fits & (t[level][np.where(fits, i, 0)] < low) if len(t[level]) else fits
                i = np.where(skip, i + (1 << level), i)
        return np.where(ref > 0, np.minimum(i, self.size), self.size)

    def _holds(self, j: np.ndarray, refs) -> np.ndarray:
        ok = np.ones(len(j), bool)
        for (_, op, _, _), v, ref in zip(self.where, self.values, refs):
            if ref is None:
                continue
            x = v.left[j]
            known = (x > 0) & (ref > 0)
            good = {"==": x == ref, "!=": x != ref, ">": known & (x > ref), ">=": known & (x >= ref),
                    "<": known & (x < ref), "<=": known & (x <= ref)}[op]
            ok &= good | (ref < 0)
        return ok

    def _refs(self, p: np.ndarray, taken: dict):
        """Per comparison the rank of the event to compare with; -1 where that step was skipped."""
        out = []
        for (_, _, other, _), v in zip(self.where, self.values):
            at = p if other == PREVIOUS else taken[other]
            out.append(np.where(at >= 0, v.right[at], -1))
        return out

    def one(self, p: np.ndarray, taken: dict) -> tuple[np.ndarray, np.ndarray]:
        """(first fitting event after p or -1, whether the next event exists and does not fit)."""
        refs = self._refs(p, taken)
        if self.contiguity == "next":
            j = np.minimum(p + 1, self.n - 1)
            there = (p + 1 < self.n) & (self.group[j] == self.group[p])
            fits = there & self.ok[j] & self._holds(j, refs)
            return np.where(fits, j, -1), there & ~fits
        i = np.searchsorted(self.at, p, side="right")
        while True:  # with one comparison a single jump is enough
            before = i
            for k, ref in enumerate(refs):
                i = np.where((ref >= 0) & (i < self.size), self._first(k, i, np.maximum(ref, 0)), i)
            if len(refs) < 2 or (i == before).all():
                break
        j = np.append(self.at, -1)[i]
        return np.where((j >= 0) & (self.group[j] == self.group[p]), j, -1), np.zeros(len(p), bool)

    def run(self, p: np.ndarray, taken: dict, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, last, stopped) of ``times`` events one after the other; -1 where there are not so many."""
        first, stopped = self.one(p, taken)
        last = first.copy()
        if times > 1 and self.contiguity == "follow" and all(w[2] == PREVIOUS for w in self.where):
            return first, self._power(first, times - 1), stopped
        for _ in range(times - 1):
            live = np.flatnonzero(last >= 0)
            nxt, cut = self.one(last[live], {k: v[live] for k, v in taken.items()})
            last[live] = nxt
            stopped[live] |= cut
        return first, last, stopped

    def _power(self, first: np.ndarray, steps: int) -> np.ndarray:
        """``steps`` further events, each found from the one before: the pointer array doubled."""
        nxt, _ = self.one(self.at, {})
        pointer = np.append(np.where(nxt >= 0, np.searchsorted(self.at, nxt), self.size), self.size)
        i = np.where(first >= 0, np.searchsorted(self.at, first), self.size)
        while steps:
            if steps & 1:
                i = pointer[i]
            pointer = pointer[pointer]
            steps >>= 1
        return np.append(self.at, -1)[i]


def _scan(table: pa.Table, steps, span: int, own: list[str], out: dict, timeout: bool) -> pa.Table:
    """Matches (and timeouts) that start in the chunks of ``table``, all at once."""
    us, seq = table["_us"].to_numpy(), table["_seq"].to_numpy()
    heads = np.zeros(table.num_rows, np.int64)
    heads[group_starts(table, ["_gk", "_chunk"])] = 1
    group = np.cumsum(heads)
    cond = [table[f"_c{k}"].to_numpy() for k in range(len(steps))]
    mine = table["_chunk"].to_numpy() == table["_own"].to_numpy()
    start = np.flatnonzero(cond[0] & mine)
    find = [_Finder(table, group, c, s) for c, s in zip(cond, steps)]
    p, live = start.copy(), np.ones(len(start), bool)
    stopped = np.zeros(len(start), bool)
    taken = {s[0]: np.full(len(start), -1, np.int64) for s in steps}
    firsts = {s[0]: np.full(len(start), -1, np.int64) for s in steps}
    inside = lambda j, at: (j >= 0) & (us[j] - us[start[at]] < span)

    def take(k: int, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        p[at] = last
        firsts[steps[k][0]][at], taken[steps[k][0]][at] = first, last

    for k, (_, _, times, _, optional) in enumerate(steps):
        at = np.flatnonzero(live)
        if k == 0:
            take(0, at, start, start)
            if times == 1:
                continue
            _, last, cut = find[0].run(p[at], {}, times - 1)
            first = start
        else:
            first, last, cut = find[k].run(p[at], {n: v[at] for n, v in taken.items()}, times)
        good = inside(last, at)
        if optional:
            without, _, _ = find[k + 1].run(p[at], {n: v[at] for n, v in taken.items()}, 1)
            good &= (without < 0) | (last < without)
        else:
            live[at[~good]] = False
            # a next step that failed within the time ends the match; otherwise its time runs out
            reach = np.minimum(p[at] + 1, len(us) - 1)
            stopped[at[~good]] = (cut & (us[reach] - us[start[at]] < span))[~good]
        take(k, at[good], first[good], last[good])
    keep = live | (~stopped if timeout else False)
    status = np.where(live, "match", "timeout")[keep]
    rows = np.flatnonzero(keep)
    cols = {a: table[a].take(pa.array(start[rows])) for a in own}
    for a, (step, col, which) in out.items():
        at = (firsts if which == "first" else taken)[step][rows]
        cols[a] = table[col].take(pa.array(np.maximum(at, 0), mask=at < 0))
    end = p[rows]
    cols |= {"status": pa.array(status, pa.string()), "s_us": pa.array(us[start[rows]]), "s_seq": pa.array(seq[start[rows]]),
             "e_us": pa.array(us[end]), "e_seq": pa.array(seq[end])}
    return pa.table(cols)
