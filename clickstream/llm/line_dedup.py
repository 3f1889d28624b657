"""Reversible incremental line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the line without ASCII white space at its ends and with A-Z lowered,
held as its 128-bit XXH3 digest in two longs.  State (three tables in the shared folder):

* ``postings (k1, k2, doc_id)``: which document holds which key, once each;
* ``refs (shard, k1, k2, refs, last)``: how many documents hold a key, and the largest id;
* ``filters (shard, n_keys, slots)``: per shard a cuckoo filter of the keys with at least
  ``min_docs`` documents.

``insert_documents`` adds postings; ``delete_documents`` takes them out again; both
recompute the counts of the touched keys only, then add or remove the fingerprints of the
keys that crossed the threshold (a filter that is full or missing is built anew from the
counts).  A delete therefore undoes an insert: ``clean`` gives what it gave before.

``clean`` probes every posting in its shard's filter, looks the few positives up in the
exact counts and cuts their lines.  Keys are counted with partial sums before the shuffle,
and a shard with many postings is probed by several tasks (salted by document, the shard's
filter copied to each), so a line that a third of the documents share burdens no single task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from clickstream.llm.common import text_bytes
from clickstream.session import materialize

#: Postings that one probing task or one shard holds, in expectation.
SHARD_ROWS = 200_000
_SLOTS = 4


class LineState(NamedTuple):
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    n_shards: int
    min_chars: int
    min_docs: int


# ------------------------------------------------------------------ keys

def line_key(raw: bytes, min_chars: int) -> bytes | None:
    """Digest of a line's key, or None when the key has fewer than ``min_chars`` code points.

    ``raw`` is A-Z lowered already.
    """
    key = raw.strip()  # bytes.strip(): exactly space and 0x09-0x0D
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def text_keys(text: bytes | None, min_chars: int) -> set[bytes]:
    if text is None or len(text) < min_chars:
        return set()
    keys = {line_key(x, min_chars) for x in text.lower().split(b"\n")}
    keys.discard(None)
    return keys


def key_postings(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Distinct ``(k1, k2, doc_id)`` of the long enough lines of rows that have an id."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = [], []
            for i, t in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                got = text_keys(t, min_chars)
                digests.extend(got)
                ids.extend([i] * len(got))
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.record_batch({"k1": np.ascontiguousarray(both[:, 0]), "k2": np.ascontiguousarray(both[:, 1]),
                                   "doc_id": pa.array(ids, pa.int64())})

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col)
    return rows.mapInArrow(scan, "k1 long, k2 long, doc_id long").distinct()


# ------------------------------------------------------------------ cuckoo filter

class CuckooFilter:
    """16-bit fingerprints, four slots a bucket, two buckets a key (the second from the first and the fingerprint).

    A fingerprint may be stored twice, so that a delete takes out one copy.
    """

    def __init__(self, slots: np.ndarray):
        self.slots = slots
        self.mask = len(slots) - 1

    @classmethod
    def sized(cls, n_keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * _SLOTS * 0.8 < n_keys + 1:
            buckets *= 2
        return cls(np.zeros((buckets, _SLOTS), np.uint16))

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, "<u2").reshape(-1, _SLOTS).copy())

    def dump(self) -> bytes:
        return self.slots.astype("<u2").tobytes()

    def _places(self, k1, k2):
        fp = (k2.astype(np.int64).view(np.uint64) >> np.uint64(48)).astype(np.uint16)
        fp[fp == 0] = 1
        first = (k1.astype(np.int64).view(np.uint64) >> np.uint64(20)).astype(np.int64) & self.mask
        return fp, first, first ^ self._jump(fp)

    def _jump(self, fp):
        return (fp.astype(np.int64) * 0x5BD1E995 >> 8) & self.mask

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        fp, a, b = self._places(k1, k2)
        return ((self.slots[a] == fp[:, None]) | (self.slots[b] == fp[:, None])).any(axis=1)

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """False when a key found no place (the caller builds a larger filter)."""
        for fp, a, b in zip(*(x.tolist() for x in self._places(k1, k2))):
            if not (self._put(a, fp) or self._put(b, fp) or self._kick(b, fp)):
                return False
        return True

    def _put(self, bucket: int, fp: int) -> bool:
        row = self.slots[bucket]
        free = np.flatnonzero(row == 0)
        if len(free):
            row[free[0]] = fp
        return bool(len(free))

    def _kick(self, bucket: int, fp: int) -> bool:
        for turn in range(500):
            slot = turn % _SLOTS
            fp, self.slots[bucket, slot] = int(self.slots[bucket, slot]), fp
            bucket ^= int(self._jump(np.array([fp]))[0])
            if self._put(bucket, fp):
                return True
        return False

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        for fp, a, b in zip(*(x.tolist() for x in self._places(k1, k2))):
            for bucket in (a, b):
                at = np.flatnonzero(self.slots[bucket] == fp)
                if len(at):
                    self.slots[bucket, at[0]] = 0
                    break


_FILTER_SCHEMA = "shard int, n_keys long, slots binary"


def _built(shard: int, k1: np.ndarray, k2: np.ndarray) -> pa.Table:
    room = len(k1)
    while True:
        f = CuckooFilter.sized(room)
        if f.insert(k1, k2):
            break
        room = 2 * room + 8
    return pa.table({"shard": pa.array([shard], pa.int32()), "n_keys": pa.array([len(k1)], pa.int64()),
                     "slots": pa.array([f.dump()], pa.binary())})


def _arrays(table: pa.Table):
    return table["k1"].to_numpy(), table["k2"].to_numpy()


def _build_filters(refs: DataFrame, min_docs: int) -> DataFrame:
    def build(t: pa.Table) -> pa.Table:
        return _built(t["shard"][0].as_py(), *_arrays(t))

    return (refs.where(F.col("refs") >= min_docs).select("shard", "k1", "k2")
            .groupBy("shard").applyInArrow(build, _FILTER_SCHEMA))


# ------------------------------------------------------------------ state

def _shard(n: int):
    return F.pmod(F.col("k1"), F.lit(n)).cast("int").alias("shard")


def _count(postings: DataFrame, n_shards: int) -> DataFrame:
    return (postings.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("refs"), F.max("doc_id").alias("last"))
            .select(_shard(n_shards), "k1", "k2", "refs", "last"))


def build_state(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                min_docs: int = 5, n_shards: int | None = None) -> LineState:
    """State after inserting ``docs`` into an empty store.

    ``n_shards`` stays for the store's life; by default one for every ``SHARD_ROWS`` postings.
    """
    postings = materialize(key_postings(docs, id_col, text_col, min_chars), "line-postings")
    n = n_shards or max(1, -(-postings.count() // SHARD_ROWS))
    refs = materialize(_count(postings, n), "line-refs")
    filters = materialize(_build_filters(refs, min_docs), "line-filters")
    return LineState(postings, refs, filters, n, min_chars, min_docs)


def _advance(state: LineState, postings: DataFrame, touched: DataFrame) -> LineState:
    """State over ``postings``, of which only the keys in ``touched (k1, k2)`` changed."""
    key = ["k1", "k2"]
    new_refs = _count(postings.join(touched, key, "left_semi"), state.n_shards)
    refs = materialize(state.refs.join(touched, key, "left_anti").unionByName(new_refs)
                       .select("shard", "k1", "k2", "refs", "last"), "line-refs")
    was = state.refs.where(F.col("refs") >= state.min_docs).join(touched, key, "left_semi").select(*key, F.lit(1).alias("w"))
    now = refs.where(F.col("refs") >= state.min_docs).join(touched, key, "left_semi").select(*key, F.lit(1).alias("n"))
    crossed = (was.join(now, key, "full").where("w is null or n is null")
               .select(_shard(state.n_shards), *key, F.col("n").isNotNull().alias("up")))

    def change(old: pa.Table, moves: pa.Table) -> pa.Table:
        if not moves.num_rows:
            return old
        k1, k2 = _arrays(moves)
        up = moves["up"].to_numpy(zero_copy_only=False).astype(bool)
        shard = moves["shard"][0].as_py()
        f = CuckooFilter.load(old["slots"][0].as_py()) if old.num_rows else CuckooFilter.sized(2 * len(k1))
        f.delete(k1[~up], k2[~up])
        n = (old["n_keys"][0].as_py() if old.num_rows else 0) + int(up.sum()) - int((~up).sum())
        full = not f.insert(k1[up], k2[up])
        return pa.table({"shard": pa.array([shard], pa.int32()), "n_keys": pa.array([-1 if full else n], pa.int64()),
                         "slots": pa.array([f.dump()], pa.binary())})

    moved = materialize(state.filters.groupBy("shard").cogroup(crossed.groupBy("shard"))
                        .applyInArrow(change, _FILTER_SCHEMA), "line-filters")
    full = moved.where("n_keys < 0").select("shard")
    rebuilt = _build_filters(refs.join(full, "shard", "left_semi"), state.min_docs)
    filters = materialize(moved.where("n_keys >= 0").unionByName(rebuilt), "line-filters")
    return state._replace(postings=postings, refs=refs, filters=filters)


def insert_documents(state: LineState, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineState:
    """State after adding ``docs``.  Lines already posted for an id are not counted again."""
    new = materialize(key_postings(docs, id_col, text_col, state.min_chars)
                      .join(state.postings, ["k1", "k2", "doc_id"], "left_anti"), "line-postings")
    postings = materialize(state.postings.unionByName(new), "line-postings")
    return _advance(state, postings, new.select("k1", "k2").distinct())


def delete_documents(state: LineState, ids: DataFrame, id_col: str = "doc_id") -> LineState:
    """State after taking out every line of the documents in ``ids``."""
    gone = ids.select(F.col(id_col).cast("long").alias("doc_id")).distinct()
    touched = materialize(state.postings.join(gone, "doc_id", "left_semi").select("k1", "k2").distinct(), "line-touched")
    postings = materialize(state.postings.join(gone, "doc_id", "left_anti"), "line-postings")
    return _advance(state, postings, touched)


def drop_lists(state: LineState) -> DataFrame:
    """``(doc_id, gone)``: per document the digests of the keys it loses (documents that lose none are absent)."""
    size = state.refs.groupBy("shard").agg(F.sum("refs").alias("size"))
    salts = size.select("shard", F.ceil(F.col("size") / SHARD_ROWS).cast("int").alias("salts"))
    probes = (state.postings.select(_shard(state.n_shards), "k1", "k2", "doc_id").join(salts, "shard")
              .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int")).drop("salts"))
    copies = (state.filters.join(salts, "shard")
              .select("shard", "slots", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))

    def probe(rows: pa.Table, filt: pa.Table) -> pa.Table:
        if filt.num_rows and rows.num_rows:
            hit = CuckooFilter.load(filt["slots"][0].as_py()).contains(*_arrays(rows))
            rows = rows.filter(pa.array(hit))
        else:
            rows = rows.slice(0, 0)
        return rows.select(["k1", "k2", "doc_id"])

    positive = (probes.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
                .applyInArrow(probe, "k1 long, k2 long, doc_id long"))
    exact = state.refs.where(F.col("refs") >= state.min_docs).select("k1", "k2", "last")
    lost = positive.join(exact, ["k1", "k2"]).where("doc_id < last")
    return lost.groupBy("doc_id").agg(F.collect_list(F.struct("k1", "k2")).alias("gone"))


def clean(state: LineState, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one more column ``lines``: ``struct(n_lines, n_dropped, kept, kept_sha256)``.

    A key of at least ``min_chars`` code points held by at least ``min_docs`` documents loses
    its lines in all of them but the one with the largest id.  Other lines stay, joined by
    ``\\n``.  Null text counts as one empty line.  Rows that share an id are one document.
    Rows without an id are not counted and lose nothing.  The other columns of ``docs`` are
    untouched, whatever their names.
    """
    min_chars = state.min_chars

    @F.arrow_udf("struct<n_lines:bigint,n_dropped:bigint,kept:string,kept_sha256:string>")
    def cut(text: pa.Array, gone: pa.Array) -> pa.Array:
        out = []
        for t, g in zip(text_bytes(text), gone.to_pylist()):
            t = t or b""
            lines = t.split(b"\n")
            kept, n = t, len(lines)
            if g:
                drop = {np.array([x["k1"], x["k2"]], "<i8").tobytes() for x in g}
                lines = [x for x in lines if line_key(x.lower(), min_chars) not in drop]
                kept = b"\n".join(lines)
            out.append((n, n - len(lines), kept.decode("utf-8", "replace"), hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*out)) or [[], [], [], []]
        return pa.StructArray.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
             pa.array(cols[3], pa.string())], names=["n_lines", "n_dropped", "kept", "kept_sha256"])

    gone = drop_lists(state).select(F.col("doc_id").alias("id"), "gone")
    row = docs.select(F.struct("*").alias("row"))
    both = row.join(gone, F.col(f"row.`{id_col}`").cast("long") == F.col("id"), "left")
    done = both.select("row", cut(F.col(f"row.`{text_col}`"), F.col("gone")).alias("lines"))
    return done.select(*[F.col(f"row.`{c}`") for c in docs.columns], "lines")
