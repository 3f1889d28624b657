"""Hard-negative mining with segment summaries as score bounds.

Every vector is cut into segments at several levels (few long ones, then more shorter ones).
Per segment its mean and its deviation (root of the mean squared difference) are stored.  For
two vectors a, b and a segment of n components

    n * (mean_a * mean_b - dev_a * dev_b) <= part of a.b <= n * (mean_a * mean_b + dev_a * dev_b)

so sums over a level's segments bound the inner product.  Pairs whose bounds cannot matter
are dropped level by level; only what is left is scored exactly.

* *Positives*: a pair matters while its upper bound reaches the worst score kept so far.
* *Negatives*: each positive score gives a band of allowed scores.  A pair matters while its
  bounds meet the band and its upper bound reaches the worst score kept so far in it.

Anchors are taken in blocks of at most ``block_anchors`` (by a hash of the distinct anchor
rows), broadcast against the written vector table; a task keeps its best rows of every anchor
(pre-aggregation), and a window per anchor merges what the tasks found.  No pair is emitted
that a task's own best rows exclude, no group is collected, and each block's rows are
appended to a written table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickstream.session import materialize, scratch_path

#: Segments per level.
LEVELS = (4, 16)
#: Pairs (or pair components) looked at together in a task.
_CELLS = 1 << 20


def segments(dim: int, count: int) -> np.ndarray:
    """Starts of ``count`` segments of nearly equal length (fewer, if there are fewer components)."""
    return np.unique(np.arange(count, dtype=np.int64) * dim // count) if dim else np.zeros(0, np.int64)


def summarise(q: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, means, deviations) of the rows' segments."""
    at = segments(q.shape[1], count)
    if not len(at):
        return np.zeros(0), np.zeros((len(q), 0)), np.zeros((len(q), 0))
    n = np.diff(np.append(at, q.shape[1])).astype(float)
    mean = np.add.reduceat(q, at, axis=1) / n
    off = q - np.repeat(mean, n.astype(int), axis=1)
    return n, mean, np.sqrt(np.add.reduceat(off * off, at, axis=1) / n)


class Rows:
    """Vectors with their summaries: whole-number components as doubles."""

    def __init__(self, q: np.ndarray):
        self.q = q
        self.levels = [summarise(q, c) for c in LEVELS]
        self.norm = np.sqrt((q * q).sum(axis=1))
        self.top = float(np.abs(q).max(initial=0.0))


def bounds(a: Rows, b: Rows, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of all inner products, widened by more than the rounding of doubles."""
    n, ma, da = a.levels[level]
    _, mb, db = b.levels[level]
    middle, spread = (ma * n) @ mb.T, (da * n) @ db.T + (a.norm[:, None] * b.norm[None, :]) * 1e-9 + 1e-6
    return middle - spread, middle + spread


def pair_bounds(a: Rows, b: Rows, level: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`bounds` of the pairs ``(i, j)`` only."""
    n, ma, da = a.levels[level]
    _, mb, db = b.levels[level]
    middle = (ma[i] * n * mb[j]).sum(axis=1)
    spread = (da[i] * n * db[j]).sum(axis=1) + a.norm[i] * b.norm[j] * 1e-9 + 1e-6
    return middle - spread, middle + spread


def exact(a: Rows, b: Rows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs ``(i, j)``."""
    dim = a.q.shape[1]
    if a.top * b.top * max(1, dim) < 1 << 53:  # every partial sum is an exact double
        if 4 * len(i) > len(a.q) * len(b.q):
            return (a.q @ b.q.T)[i, j].astype(np.int64)
        out = np.empty(len(i), np.int64)
        step = max(1, _CELLS // max(1, dim))
        for s in range(0, len(i), step):
            out[s:s + step] = np.einsum("nd,nd->n", a.q[i[s:s + step]], b.q[j[s:s + step]]).astype(np.int64)
        return out
    whole = [sum(int(x) * int(y) for x, y in zip(a.q[x_], b.q[y_])) for x_, y_ in zip(i.tolist(), j.tolist())]
    return np.array(whole, np.int64)  # raises OverflowError beyond 64 bits


class Best:
    """The ``most`` best (score, smaller id first) entries of each of ``n`` groups."""

    def __init__(self, n: int, most: int):
        self.n, self.most = n, most
        self.group = self.score = self.id = np.zeros(0, np.int64)
        self.worst = np.full(n, -np.inf)  # score that a new entry must reach

    def add(self, group: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(group):
            return
        g, s, d = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.id, id_)))
        order = np.lexsort((d, -s, g))
        g, s, d = g[order], s[order], d[order]
        place = np.arange(len(g)) - np.searchsorted(g, g)
        keep = place < self.most
        self.group, self.score, self.id = g[keep], s[keep], d[keep]
        last = place == self.most - 1
        self.worst[g[last]] = s[last]


def survivors(a: Rows, b: Rows, alive: np.ndarray, floor: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of ``alive`` whose score can be in ``[floor, high]`` of their anchor, by level after level.

    While many pairs are left a level is one matrix product, then it is computed pair by pair.
    """
    for level in range(len(LEVELS)):
        left = np.count_nonzero(alive)
        if not left:
            break
        if left > 0.1 * alive.size:
            least, most = bounds(a, b, level)
            alive &= (most >= floor[:, None]) & (least <= high[:, None])
        else:
            x, y = np.nonzero(alive)
            least, most = pair_bounds_in_slices(a, b, level, x, y)
            alive[x, y] = (most >= floor[x]) & (least <= high[x])
    return np.nonzero(alive)


def add_positives(best: Best, a: Rows, a_id, a_label, b: Rows, b_id, b_label) -> None:
    """Offer the rows of ``b`` to the anchors of the same label."""
    for label in np.intersect1d(a_label, b_label):
        ai, bi = np.flatnonzero(a_label == label), np.flatnonzero(b_label == label)
        sub_b = _take(b, bi)
        step = max(1, _CELLS // max(1, len(bi)))
        for s in range(0, len(ai), step):
            part = ai[s:s + step]
            sub_a = _take(a, part)
            floor = best.worst[part]
            x, y = survivors(sub_a, sub_b, a_id[part][:, None] != b_id[bi][None, :], floor, np.full(len(part), np.inf))
            score = exact(sub_a, sub_b, x, y)
            good = score >= floor[x]
            best.add(part[x[good]], score[good], b_id[bi[y[good]]])


def add_negatives(best: Best, band: dict[str, np.ndarray], a: Rows, a_id, a_label, b: Rows, b_id, b_label) -> None:
    """Offer the rows of ``b`` to the bands of the anchors of other labels.

    ``band`` has one entry per band: its anchor ``at`` (ascending), its lowest and highest
    score.  A pair is bounded and scored once for all bands of its anchor.
    """
    step = max(1, _CELLS // max(1, len(b_id)))
    need = np.maximum(band["low"], best.worst)
    for s in range(0, len(a_id), step):
        first, stop = np.searchsorted(band["at"], [s, s + step])
        if first == stop:
            continue
        own, start, count = np.unique(band["at"][first:stop], return_index=True, return_counts=True)
        sub = _take(a, own)
        other = (a_label[own][:, None] != b_label[None, :]) & (a_id[own][:, None] != b_id[None, :])
        floor = np.minimum.reduceat(need[first:stop], start)
        high = np.maximum.reduceat(band["high"][first:stop], start).astype(float)
        x, y = survivors(sub, b, other, floor, high)
        score = exact(sub, b, x, y)
        inside = (score >= floor[x]) & (score <= high[x])
        x, y, score = x[inside], y[inside], score[inside]
        for k in range(int(count.max())):  # the k-th band of each anchor
            has = count[x] > k
            at = first + start[x[has]] + k
            fits = (score[has] >= need[at]) & (score[has] <= band["high"][at])
            best.add(at[fits], score[has][fits], b_id[y[has][fits]])


def pair_bounds_in_slices(a: Rows, b: Rows, level: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.empty(len(i)), np.empty(len(i))
    step = _CELLS // LEVELS[level]
    for s in range(0, len(i), step):
        low[s:s + step], high[s:s + step] = pair_bounds(a, b, level, i[s:s + step], j[s:s + step])
    return low, high


def _take(rows: Rows, at: np.ndarray) -> Rows:
    out = Rows.__new__(Rows)
    out.q, out.norm, out.top = rows.q[at], rows.norm[at], rows.top
    out.levels = [(n, m[at], d[at]) for n, m, d in rows.levels]
    return out


def _load(ids: pa.Array, labels: pa.Array, packed: pa.Array, dim: int) -> tuple[Rows, np.ndarray, np.ndarray]:
    q = np.frombuffer(b"".join(packed.to_pylist()), "<f8").reshape(-1, dim) if dim else np.zeros((len(ids), 0))
    return Rows(q), ids.to_numpy(zero_copy_only=False), np.array(labels.to_pylist(), object).astype(str)


def vector_table(df: DataFrame, id_col: str, label_col: str, vector_col: str, scale: float) -> tuple[DataFrame, int]:
    """(written table ``id, label, packed``, number of components): the rows that take part.

    Each component x is floor(scale * x) as a double; shorter vectors are filled with zeros.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                     F.col(vector_col).cast("array<double>").alias("v"))
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(ok, F.lit(False)))
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(2).to_pylist():
                q = np.zeros(dim)
                q[:len(v)] = np.floor(scale * np.array(v, float))
                out.append(q.astype("<f8").tobytes())
            yield pa.record_batch({"id": batch.column(0), "label": batch.column(1).cast(pa.string()), "packed": pa.array(out, pa.binary())})

    return materialize(rows.mapInArrow(pack, "id long, label string, packed binary"), "vectors"), dim


def mine(df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector", scale: float = 256.0,
         block_anchors: int = 4096) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    An anchor's positives are its ``positives`` best other rows of the same label; for each of
    them, its negatives are the ``negatives`` best rows of another label with a score between
    ``low`` and ``high`` percent of the positive's.  Scores are inner products of the
    components floor(scale * x); higher ones come first, ties by smaller id.

    Rows with a null id, label or vector, or a null or non-finite component take no part.  A
    shorter vector is filled with zeros.  Rows with an anchor's id are neither its positives nor
    its negatives.  Repeated rows count as rows; an anchor that repeats in full is one anchor.
    Positives without negatives, anchors without positives and empty tables give no rows.
    Scores beyond 64 bits raise an error.  ``is_anchor`` is a condition on ``df``.
    """
    spark = df.sparkSession
    table, dim = vector_table(df, id_col, label_col, vector_col, scale)
    ids = df.where(is_anchor).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label")).distinct()
    anchors = materialize(table.join(ids, ["id", "label"], "left_semi").distinct(), "anchors")
    n_blocks = max(1, -(-anchors.count() // block_anchors))
    path = scratch_path(spark, f"hard-negatives-{uuid.uuid4().hex}")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    for k in range(n_blocks):
        _mine_block(table, anchors.where(F.pmod(F.xxhash64("id", "label", "packed"), F.lit(n_blocks)) == k), dim,
                    positives, negatives, low, high).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _scan(table: DataFrame, step, finish, schema: str) -> DataFrame:
    """Run ``step`` over the batches of every task, then emit what ``finish`` makes of the task's state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows:
                state = step(state, batch)
        if state is not None:
            yield finish(state)

    return table.mapInArrow(run, schema)


def _best_rows(best: Best) -> pa.RecordBatch:
    return pa.record_batch({"g": best.group, "id": best.id, "score": best.score})


def _top(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("g").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _mine_block(table: DataFrame, anchors: DataFrame, dim: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """One block: its anchors, their positives and bands are bounded by ``block_anchors``."""
    spark = table.sparkSession
    block = anchors.toArrow()
    own, a_id, a_label = _load(*(block[c].combine_chunks() for c in ("id", "label", "packed")), dim)
    shared = spark.sparkContext.broadcast((own, a_id, a_label))

    def offer_positives(best, batch):
        a = shared.value
        best = best or Best(len(a[1]), positives)
        add_positives(best, *a, *_load(*batch.columns, dim))
        return best

    kind = "g long, id long, score long"
    found = _top(_scan(table, offer_positives, _best_rows, kind), positives)
    pos = found.select("g", "id", "score").toArrow()  # at most block_anchors * positives rows
    g, s = pos["g"].to_numpy(), pos["score"].to_numpy()
    lows, highs = [-(-(low * x) // 100) for x in s.tolist()], [(high * x) // 100 for x in s.tolist()]
    bands = sorted({(int(a), x, y) for a, x, y in zip(g, lows, highs) if x <= y})
    number = {b: n for n, b in enumerate(bands)}
    band = spark.sparkContext.broadcast({
        "at": np.array([b[0] for b in bands], np.int64), "low": np.array([b[1] for b in bands], np.int64),
        "high": np.array([b[2] for b in bands], np.int64)})

    def offer_negatives(best, batch):
        best = best or Best(len(band.value["at"]), negatives)
        add_negatives(best, band.value, *shared.value, *_load(*batch.columns, dim))
        return best

    hits = _top(_scan(table, offer_negatives, _best_rows, kind), negatives)
    rows = [(number[int(a), x, y], int(a_id[a]), p, sc) for a, p, sc, x, y in
            zip(g, pos["id"].to_pylist(), s.tolist(), lows, highs) if x <= y]
    pairs = spark.createDataFrame(rows, "g long, anchor_id long, positive_id long, positive_score long")
    return pairs.join(hits, "g").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                                        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
