"""Benchmark decontamination by a prefix-filtered set join.

Records are item windows: every run of ``window`` consecutive words of an item (an item of
fewer words is one window).  A document contains a window when the same words follow each
other somewhere in it.

* *Order by rarity.*  Words are ordered by how often they occur in all documents (counted
  for the benchmark's vocabulary in one pass).
* *Necessary prefix.*  Containment is whole, so the first word of a window in that order,
  its rarest, must occur in the document: only that word is joined on.
* *Length and position bounds.*  The join knows the word's offset in its window, so each
  meeting gives one possible place; places that begin before the document or end after it
  are out.
* *Verification.*  At a place that is left, the rolling hash of exactly the window's number
  of words is compared, then the words themselves byte by byte.

The windows are held as a broadcast index of at most ``block_windows`` windows.  A larger
benchmark is taken in as many blocks (each one scan of the documents, hits carried on in a
written table), so neither the driver nor a worker ever holds more than one block.  Scanning
is numpy over the raw bytes of a few documents at a time; texts are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickstream.llm.common import by_size, fresh, text_bytes
from clickstream.session import materialize

#: Bytes of text scanned at a time (longer texts are scanned alone).
SCAN_BYTES = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MULT_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))
_STEP = 0xC2B2AE3D27D4EB4F

# A word byte is a digit, a letter or part of a character outside ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

_powers = {"n": 0}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``MULT ** i`` and its inverse for i < n (kept between calls, never beyond the longest text)."""
    if _powers["n"] < n:
        for name, base in (("up", _MULT), ("down", _MULT_INV)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
        _powers["n"] = n
    return _powers["up"][:n], _powers["down"][:n]


def split_words(buf: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lowered bytes, starts, ends, 64-bit hashes) of the words of ``buf``."""
    low = _LOWER[np.frombuffer(buf, np.uint8)]
    is_word = _WORD[low]
    edge = np.flatnonzero(np.diff(is_word.astype(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return low, starts, ends, np.empty(0, np.uint64)
    up, down = _power(len(buf) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:-1])))
    h = (total[ends] - total[starts]) * down[starts]
    h ^= h >> np.uint64(29)
    return low, starts, ends, h * np.uint64(0xBF58476D1CE4E5B9)


def window_hash(h: np.ndarray) -> int:
    """Hash of a sequence of word hashes."""
    out = 0
    for x in h.tolist():
        out = (out * _STEP + x) & (1 << 64) - 1
    return out


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct ``(words, item_id)``: the windows of every item, words joined by a space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ids = [], []
            for i, t in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                low, s, e, _ = split_words(t or b"")
                raw = low.tobytes()
                w = [raw[a:b] for a, b in zip(s.tolist(), e.tolist())]
                for k in range(max(1, len(w) - window + 1) if w else 0):
                    words.append(b" ".join(w[k:k + window]).decode("utf-8", "replace"))
                    ids.append(i)
            yield pa.record_batch({"words": pa.array(words, pa.string()), "item_id": pa.array(ids, pa.string())})

    items = benchmark.select(F.col(id_col).cast("string"), text_col)
    return items.mapInArrow(cut, "words string, item_id string").distinct()


class WindowIndex:
    """The windows of one block by their rarest word."""

    def __init__(self, windows: list[tuple[str, list[str]]], frequency: dict[int, int]):
        by_word = defaultdict(list)
        self.items = [ids for _, ids in windows]
        self.text = [w.encode() for w, _ in windows]
        sizes, hashes, offsets = [], [], []
        for k, t in enumerate(self.text):
            _, _, _, h = split_words(t)
            rare = min(range(len(h)), key=lambda o: (frequency.get(int(h[o].view(np.int64)), 0), int(h[o]), o))
            by_word[int(h[rare])].append(k)
            sizes.append(len(h))
            offsets.append(rare)
            hashes.append(window_hash(h))
        self.size = np.array(sizes, np.int64)
        self.offset = np.array(offsets, np.int64)
        self.hash = np.array(hashes, np.uint64)
        words = sorted(by_word)
        self.word = np.array(words, np.uint64)
        self.members = np.array([k for w in words for k in by_word[w]], np.int64)
        self.count = np.array([len(by_word[w]) for w in words], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.count)))[:-1].astype(np.int64)

    def find(self, texts: list[bytes | None]):
        """Per text: (number of words, list of (first word, end word), set of item ids)."""
        buf = b"\0".join([t or b"" for t in texts])
        low, starts, ends, h = split_words(buf)
        lens = np.array([len(t or b"") + 1 for t in texts], np.int64)
        doc_end = np.searchsorted(starts, np.cumsum(lens))  # words before the end of each text
        doc_start = np.concatenate(([0], doc_end[:-1]))
        out = [(int(b - a), [], set()) for a, b in zip(doc_start, doc_end)]
        if not len(self.word) or not len(h):
            return out
        at = np.searchsorted(self.word, h)
        at[at == len(self.word)] = 0
        pos = np.flatnonzero(self.word[at] == h)
        if not len(pos):
            return out
        doc = np.searchsorted(doc_end, pos, side="right")
        raw = low.tobytes()
        for a in range(0, len(pos), 4096):  # a very common prefix word meets many windows: in slices
            p, d, u = pos[a:a + 4096], doc[a:a + 4096], at[pos[a:a + 4096]]
            n = self.count[u]
            who = np.repeat(np.arange(len(p)), n)
            k = self.members[np.repeat(self.first[u], n) + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)]
            begin = p[who] - self.offset[k]
            fits = (begin >= doc_start[d[who]]) & (begin + self.size[k] <= doc_end[d[who]])
            k, begin, own = k[fits], begin[fits], d[who[fits]]
            got = np.zeros(len(k), np.uint64)
            size = self.size[k]
            for o in range(int(size.max()) if len(k) else 0):
                on = size > o
                got[on] = got[on] * np.uint64(_STEP) + h[begin[on] + o]
            same = got == self.hash[k]
            for kk, b, i in zip(k[same].tolist(), begin[same].tolist(), own[same].tolist()):
                end = b + int(self.size[kk])
                if b" ".join([raw[s:e] for s, e in zip(starts[b:end].tolist(), ends[b:end].tolist())]) == self.text[kk]:
                    first = int(doc_start[i])
                    out[i][1].append((b - first, end - first))
                    out[i][2].update(self.items[kk])
        return out


def word_frequency(docs: DataFrame, text_col: str, vocabulary: np.ndarray) -> DataFrame:
    """``(h, n)``: occurrences of the vocabulary's words (hashes as longs) over all documents."""
    vocabulary = np.sort(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for a, b in by_size(texts, SCAN_BYTES):
                h = split_words(b"\0".join([t or b"" for t in texts[a:b]]))[3]
                at = np.searchsorted(vocabulary, h)
                at[at == len(vocabulary)] = 0
                total += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
        seen = np.flatnonzero(total)
        yield pa.record_batch({"h": vocabulary[seen].view(np.int64), "n": total[seen]})

    return (docs.select(text_col).mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))


def _merge_hits(spans, items):
    """Number of covered words, sorted items: native expressions over the collected hits."""
    ordered = F.array_sort(spans)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        ordered, start,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["end"]))).cast("long").alias("n"),
            F.greatest(acc["end"], x["e"]).alias("end")),
        lambda acc: acc["n"])
    return covered, F.array_sort(F.array_distinct(items))


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, block_windows: int = 200_000,
                  out: str = "leak") -> DataFrame:
    """``docs`` with one more column ``out``: ``struct(n_words, n_hit, items, contaminated)``.

    Words are runs of digits, letters and characters outside ASCII, A-Z lowered.  ``n_hit``
    counts the words inside any occurrence of any window, ``items`` are the ids (as sorted
    strings) of items with an occurring window.  Null or wordless texts have no words and
    hit nothing; so do null items.  Items with a null id count for ``n_hit`` but are not
    listed.  Every row of ``docs`` gets its own result, also when ids repeat.  An empty benchmark hits nothing.  Other columns stay, whatever their names.
    """
    spark = docs.sparkSession
    windows = materialize(item_windows(benchmark, item_col, item_text_col, window)
                          .groupBy("words").agg(F.collect_set("item_id").alias("ids")), "leak-windows")
    n_blocks = max(1, -(-windows.count() // block_windows))
    state = docs.select(F.struct("*").alias("row"))
    kind = "struct<n_words:bigint,spans:array<struct<s:int,e:int>>,items:array<string>>"
    for k in range(n_blocks):
        # one block: about block_windows windows by hash, whatever the benchmark's size
        rows = [(r.words, r.ids) for r in
                windows.where(F.pmod(F.xxhash64("words"), F.lit(n_blocks)) == k).toLocalIterator()]
        vocabulary = np.unique(split_words(" ".join(w for w, _ in rows).encode())[3])
        counted = (word_frequency(docs, text_col, vocabulary).collect() if len(vocabulary) else [])
        index = spark.sparkContext.broadcast(WindowIndex(rows, {r.h: r.n for r in counted}))

        @F.arrow_udf(kind)
        def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            own = index.value
            for arr in batches:
                texts = text_bytes(arr)
                found = []
                for a, b in by_size(texts, SCAN_BYTES):
                    found.extend(own.find(texts[a:b]))
                yield pa.array([{"n_words": n, "spans": [{"s": s, "e": e} for s, e in sorted(set(spans))],
                                 "items": sorted(ids)} for n, spans, ids in found],
                               pa.struct([("n_words", pa.int64()),
                                          ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                                          ("items", pa.list_(pa.string()))]))

        state = state.withColumn("new", scan(F.col(f"row.`{text_col}`")))
        if k:
            state = state.withColumn("new", F.struct(
                F.col("new.n_words").alias("n_words"), F.concat("hits.spans", "new.spans").alias("spans"),
                F.concat("hits.items", "new.items").alias("items")))
        state = state.select("row", F.col("new").alias("hits"))
        if k + 1 < n_blocks:
            state = materialize(state, "leak-block")
    n_hit, items = _merge_hits(F.col("hits.spans"), F.col("hits.items"))
    leak = F.struct(F.col("hits.n_words").alias("n_words"), n_hit.alias("n_hit"), items.alias("items"),
                    (F.size("hits.spans") > 0).alias("contaminated"))
    return state.select(*[F.col(f"row.`{c}`") for c in docs.columns], leak.alias(out))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no window of any benchmark item; columns unchanged."""
    leak = fresh(docs, "leak")
    marked = contamination(docs, benchmark, out=leak, **options)
    return marked.where(~F.col(f"{leak}.contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])
