"""Ranked lexical search for many queries at once, sharing their common parts.

*Terms.*  One pass over the documents finds, per text, its number of terms and how often it
holds the terms of the queries; that short form is a written table, read by all later steps.
Words are found by their hashes and compared byte by byte.

*Sharing.*  The score of a document for an item is a sum over the item's terms, so items with
common terms have common partial sums.  :class:`Plan` mines them once on the driver:

1. terms (with their number of occurrences) that are in exactly the same items are one node;
2. while some two nodes are together in several items, the pair that is in most becomes a
   node of its own and replaces the two in those items.

The result is a graph of nodes whose values are sums of others'.  Over a batch of documents
each node's value (one accumulator per document) is computed once, in that order; an item is
the sum of the few nodes left in it.

*Ranking.*  A task keeps its best documents of every item; a window per item merges them, first
within salted parts of an item's rows, then over the parts.  Items are taken in blocks of
``block_items``, so the vocabulary and the accumulators are bounded however many there are.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickstream.llm.common import by_size, text_bytes
from clickstream.llm.decontam import SCAN_BYTES, split_words
from clickstream.session import materialize, scratch_path

#: Accumulator cells (nodes x documents) held at a time.
_CELLS = 1 << 21
#: Most shared nodes that pairs are mined among (a bound on the plan's work, not on results).
_PAIR_NODES = 2048
_UNIT = 1_000_000_000


class Vocabulary:
    """The distinct terms of a block of items."""

    def __init__(self, terms: list[bytes]):
        self.terms = sorted(set(terms))
        h = split_words(b" ".join(self.terms))[3]
        order = np.argsort(h, kind="stable")
        self.hash, self.term = h[order], order.astype(np.int64)
        self.size = np.array([len(t) for t in self.terms], np.int64)
        width = int(self.size.max(initial=0))
        self.bytes = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in self.terms), np.uint8).reshape(len(self.terms), width)

    def find(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(terms per text, text of each known word, its term)."""
        low, starts, ends, h = split_words(b"\0".join([t or b"" for t in texts]))
        stop = np.searchsorted(starts, np.cumsum([len(t or b"") + 1 for t in texts]))
        n = np.diff(np.append(0, stop))
        if not len(self.hash) or not len(h):
            return n, np.zeros(0, np.int64), np.zeros(0, np.int64)
        first, after = np.searchsorted(self.hash, h), np.searchsorted(self.hash, h, side="right")
        pos, term = [], []
        for step in range(int((after - first).max())):  # more than one only if two terms share a hash
            at = np.flatnonzero(first + step < after)
            t = self.term[first[at] + step]
            same = (ends - starts)[at] == self.size[t]
            at, t = at[same], t[same]
            for size in np.unique(self.size[t]).tolist():  # the words themselves
                own = np.flatnonzero(self.size[t] == size)
                for a in range(0, len(own), _CELLS // size + 1):
                    some = own[a:a + _CELLS // size + 1]
                    read = low[starts[at[some]][:, None] + np.arange(size)]
                    good = (read == self.bytes[t[some], :size]).all(axis=1)
                    pos.append(at[some][good])
                    term.append(t[some][good])
        pos, term = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (pos, term))
        return n, np.searchsorted(stop, pos, side="right"), term


class Plan:
    """The sharing graph of a block of items.

    ``leaves[k]`` is a term and how often the item holds it; ``nodes[j]`` lists the members of
    node ``len(leaves) + j``: leaves or earlier nodes.  ``items[i]`` lists what item i adds up.
    """

    def __init__(self, items: list[dict[int, int]]):
        holders = defaultdict(list)
        for i, own in enumerate(items):
            for leaf in own.items():
                holders[leaf].append(i)
        self.leaves = sorted(holders)
        self.nodes: list[tuple[int, ...]] = []
        alike = defaultdict(list)  # leaves in exactly the same items
        for k, leaf in enumerate(self.leaves):
            alike[tuple(holders[leaf])].append(k)
        where: dict[int, set[int]] = {}
        for who in sorted(alike):
            where[self._node(alike[who])] = set(who)
        self._pairs(where)
        self.items = [[] for _ in items]
        for node, who in where.items():
            for i in who:
                self.items[i].append(node)
        for own in self.items:
            own.sort()

    def _node(self, members) -> int:
        if len(members) == 1:
            return members[0]
        self.nodes.append(tuple(members))
        return len(self.leaves) + len(self.nodes) - 1

    def _pairs(self, where: dict[int, set[int]]) -> None:
        """Replace the pair of nodes that most items share by one node, as long as two items share one."""
        shared = sorted((n for n in where if len(where[n]) > 1), key=lambda n: (-len(where[n]), n))[:_PAIR_NODES]
        if len(shared) < 2:
            return
        who = np.zeros((len(shared), 1 + max(max(where[n]) for n in shared)), np.int32)
        for k, n in enumerate(shared):
            who[k, list(where[n])] = 1
        both = who @ who.T
        np.fill_diagonal(both, 0)
        while True:
            k = int(both.argmax())
            a, b = divmod(k, len(shared))
            if both[a, b] < 2:
                break
            common = who[a] & who[b]
            old = [shared[a], shared[b]]
            new = self._node(old)
            where[new] = set(np.flatnonzero(common).tolist())
            for x, n in ((a, old[0]), (b, old[1])):
                where[n] -= where[new]
                who[x] -= common
            # a takes what is left of its items, unless nothing is: then the new node has its place
            slot = a if not who[a].any() else b if not who[b].any() else -1
            if slot < 0:
                shared.append(new)
                who = np.vstack((who, common))
                both = np.pad(both, ((0, 1), (0, 1)))
                slot = len(shared) - 1
            else:
                shared[slot], who[slot] = new, common
            for x in {a, b, slot}:
                both[x] = both[:, x] = who @ who[x]
                both[x, x] = 0
        for n in [n for n in where if not where[n]]:
            del where[n]

    def additions(self) -> int:
        """Additions per document."""
        return sum(len(n) - 1 for n in self.nodes) + sum(max(0, len(i) - 1) for i in self.items)

    def scores(self, leaf_values: np.ndarray) -> np.ndarray:
        """(items, documents) from the leaves' values (leaves, documents): every node once, in order."""
        value = np.empty((len(self.leaves) + len(self.nodes), leaf_values.shape[1]), np.int64)
        value[:len(self.leaves)] = leaf_values
        for k, members in enumerate(self.nodes, len(self.leaves)):
            np.sum(value[list(members)], axis=0, out=value[k])
        out = np.zeros((len(self.items), leaf_values.shape[1]), np.int64)
        for i, own in enumerate(self.items):
            if own:
                np.sum(value[own], axis=0, out=out[i])
        return out


def term_table(docs: DataFrame, id_col: str, text_col: str, vocabulary) -> DataFrame:
    """Written ``(id, n, terms, times)``: number of terms, and the known ones as packed integers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        for batch in batches:
            texts = text_bytes(batch.column(1))
            n_all, terms, times = [], [], []
            for a, b in by_size(texts, SCAN_BYTES):
                n, doc, term = words.find(texts[a:b])
                both, k = np.unique(doc * max(1, len(words.terms)) + term, return_counts=True)
                d, t = np.divmod(both, max(1, len(words.terms)))
                cut = np.searchsorted(d, np.arange(b - a + 1))
                n_all.append(n)
                t, k = t.astype("<i4"), k.astype("<i8")
                terms += [t[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])]
                times += [k[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])]
            yield pa.record_batch({
                "id": batch.column(0), "n": pa.array(np.concatenate(n_all) if n_all else np.zeros(0, np.int64), pa.int64()),
                "terms": pa.array(terms, pa.binary()), "times": pa.array(times, pa.binary())})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string"))
    return materialize(rows.mapInArrow(count, "id long, n long, terms binary, times binary"), "lexical-terms")


def document_numbers(table: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents with terms, all terms, documents per known term)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.record_batch({"t": seen, "df": total[seen]})

    n = table.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(size, np.int64)
    for r in table.select("terms").mapInArrow(count, "t long, df long").groupBy("t").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r.t] = r.df  # one row per term of the block's items
    return n.docs, n.terms, df


class Best:
    """The best documents of every item: higher scores first, then smaller ids, null ids last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.worst = np.zeros(items, np.int64)  # a kept score must be positive and reach this
        self.item = self.score = self.id = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        item, doc = np.nonzero((scores > 0) & (scores >= self.worst[:, None]))
        g, s, d, z = (np.concatenate(x) for x in ((self.item, item), (self.score, scores[item, doc]),
                                                  (self.id, ids[doc]), (self.null, null[doc])))
        order = np.lexsort((d, z, -s, g))
        g, s, d, z = g[order], s[order], d[order], z[order]
        place = np.arange(len(g)) - np.searchsorted(g, g)
        keep = place < self.top
        self.item, self.score, self.id, self.null = g[keep], s[keep], d[keep], z[keep]
        last = place == self.top - 1
        self.worst[g[last]] = s[last]


def search(docs: DataFrame, items: DataFrame, top: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_items: int = 1000) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` best documents of every row of ``items``.

    Terms are runs of digits, letters and characters outside ASCII, A-Z lowered.  With N
    documents that have terms, L terms in all, n terms in a document, df documents with the
    term and tf its occurrences there, a term's weight is w = floor(1000 * ln((2N + 2) / (2df + 1))),
    m = 75 + (25 * n * N) div L, and the document's score is the sum of
    w * ((10^9 * tf) div (1000 * tf + 12 * m)) over the item's terms, repeats included.

    Only scores above 0 are listed; equal ones by ascending id (null ids last).  Null and wordless
    texts score nothing; items without terms and empty tables give no rows.  Repeated rows of
    either table count as rows of their own.  Other columns are not read.
    """
    spark = docs.sparkSession
    numbered = materialize(items.select(F.monotonically_increasing_id().alias("row"), F.col(item_col).alias("item_id"),
                                        F.col(item_text_col).cast("string").alias("text")), "lexical-items")
    n_blocks = max(1, -(-numbered.count() // block_items))
    path = scratch_path(spark, f"lexical-search-{uuid.uuid4().hex}")
    kind = f"item_id {numbered.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
    spark.createDataFrame([], kind).write.mode("append").parquet(path)
    for k in range(n_blocks):
        block = numbered.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == k).orderBy("row").toArrow()
        _search_block(docs, block, top, id_col, text_col).write.mode("append").parquet(path)
    return spark.read.schema(kind).parquet(path)


def _item_terms(texts: list[bytes | None]) -> list[list[bytes]]:
    out = []
    for t in texts:
        low, s, e, _ = split_words(t or b"")
        raw = low.tobytes()
        out.append([raw[a:b] for a, b in zip(s.tolist(), e.tolist())])
    return out


def _search_block(docs: DataFrame, block: pa.Table, top: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    words = _item_terms(text_bytes(block["text"]))
    vocabulary = Vocabulary([w for own in words for w in own])
    number = {t: k for k, t in enumerate(vocabulary.terms)}
    counted = [defaultdict(int) for _ in words]
    for own, count in zip(words, counted):
        for w in own:
            count[number[w]] += 1
    plan = Plan(counted)
    table = term_table(docs, id_col, text_col, spark.sparkContext.broadcast(vocabulary))
    n_docs, n_terms, df = document_numbers(table, len(vocabulary.terms))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    shared = spark.sparkContext.broadcast((plan, weight))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weight = shared.value
        best = Best(len(plan.items), top)
        leaf_term = np.array([t for t, _ in plan.leaves], np.int64)
        leaf_times = np.array([c for _, c in plan.leaves], np.int64)
        step = max(1, _CELLS // max(1, 2 * len(plan.leaves) + len(plan.nodes) + len(plan.items)))
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                packed = batch.column(2).to_pylist()
                term = np.frombuffer(b"".join(packed), "<i4").astype(np.int64)
                tf = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i8")
                doc = np.repeat(np.arange(len(packed)), [len(p) // 4 for p in packed])
                n = batch.column(1).to_numpy(zero_copy_only=False)
                m = 75 + (25 * n * n_docs) // max(1, n_terms)
                value = np.zeros((len(weight), len(packed)), np.int64)
                value[term, doc] = weight[term] * ((_UNIT * tf) // (1000 * tf + 12 * m[doc]))
                scores = plan.scores(value[leaf_term] * leaf_times[:, None])
                null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
                best.add(scores, batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), null)
        yield pa.record_batch({"item": best.item, "id": pa.array(best.id, pa.int64(), mask=best.null), "score": best.score})

    found = table.mapInArrow(rank, "item long, id long, score long").withColumn("part", F.spark_partition_id() % 32)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    for by in (["item", "part"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    # block_items rows; a null id must not be lost in a join, so ids are joined by row number
    ids = spark.createDataFrame(pa.table({"item": pa.array(range(len(block)), pa.int64()), "item_id": block["item_id"]}))
    return found.join(ids, "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")
