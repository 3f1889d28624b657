"""SimHash near-duplicate groups by bit-sliced comparison.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its word
shingles.  Two fingerprints link when they differ in at most ``radius`` bits; a group is
what links reach.

1. ``fingerprints``: one pass over the texts, written as a small table.
2. Equal fingerprints collapse to one vertex (with its smallest id) before anything is
   compared, so exact copies cost nothing.
3. ``near_links``: ``radius + 1`` bit bands (pigeonhole: within the radius at least one
   band, or every choice of ``choose`` out of ``radius + choose`` bands, agrees).  Rows of
   a band value are compared in bit planes: 64 fingerprints to a machine word, one XOR a
   plane, distances in carry-save counters, and word blocks dropped once every lane is
   over the radius.  Only spanning links leave a task (at most one a row), so a dense
   group never turns into its pairs.  A band value with more than ``tile`` rows is cut into
   tiles and each pair of tiles is a group of its own, so no task holds a hot value.
4. ``components``: alternating large-star / small-star rounds on the links, each written
   to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clickstream.llm.common import fresh, text_bytes
from clickstream.session import materialize

#: Shingles unpacked to bits at a time.
_UNPACK = 1 << 15
#: (row, word block) pairs compared at a time.
_COMBOS = 1 << 14
#: Links that one task of a component round writes.
LINKS_PER_FILE = 500_000


def simhash(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """Fingerprint of one text: A-Z lowered, words are runs without ASCII white space.

    Fewer words than ``shingle`` (but some): the whole sequence is the one shingle.  No
    word or null: 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    buf = b" ".join(words)
    h = xxhash.xxh64_digest
    if len(words) <= shingle:
        digests = h(buf, seed)
    else:
        gaps = np.flatnonzero(np.frombuffer(buf, np.uint8) == 32)
        starts = np.concatenate(([0], gaps + 1))[:len(words) - shingle + 1].tolist()
        ends = np.concatenate((gaps, [len(buf)]))[shingle - 1:].tolist()
        digests = b"".join([h(buf[a:b], seed) for a, b in zip(starts, ends)])
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for a in range(0, len(rows), _UNPACK):
        ones += np.unpackbits(rows[a:a + _UNPACK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4, also: Column | None = None) -> DataFrame:
    """``(doc_id, fp)`` of every row, and ``also``; ``fp`` is the fingerprint as a signed long."""

    @F.arrow_udf("long")
    def fp(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            got = np.array([simhash(t, shingle) for t in text_bytes(arr)], np.uint64)
            yield pa.array(got.view(np.int64))

    return docs.select(F.col(id_col).alias("doc_id"), fp(F.col(text_col)).alias("fp"), *([] if also is None else [also]))


# ------------------------------------------------------------ bit-sliced comparison

def _planes(fps: np.ndarray, lane: np.ndarray, n_words: int) -> np.ndarray:
    """Bit planes: ``planes[b, w]`` has bit ``l`` set when the row at lane ``64 w + l`` has bit ``b``."""
    grid = np.zeros(n_words * 64, np.uint64)
    grid[lane] = fps
    out = np.empty((64, n_words), np.uint64)
    for b in range(64):
        bits = ((grid >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        out[b] = np.packbits(bits, bitorder="little").view("<u8")
    return out


def _within(planes, fps, rows, words, valid, radius):
    """Lane masks: for each (row, word block), the lanes within ``radius`` bits of the row.

    Counters are carry-save: two planes a step go through a full adder into the ones, every
    second carry into the twos, and so on; eights stick.  Blocks whose valid lanes have all
    passed the radius are taken out every 16 planes.
    """
    n = len(rows)
    out = np.zeros(n, np.uint64)
    live = np.arange(n)
    one, two, four, eight = (np.zeros(n, np.uint64) for _ in range(4))
    for b in range(0, 64, 4):
        q = fps[rows]
        d = []
        for k in range(4):
            bit = (q >> np.uint64(b + k)) & np.uint64(1)
            d.append(planes[b + k, words] ^ (np.uint64(0) - bit))
        u = one ^ d[0]
        c1 = (one & d[0]) | (u & d[1])
        one = u ^ d[1]
        u = one ^ d[2]
        c2 = (one & d[2]) | (u & d[3])
        one = u ^ d[3]
        u = two ^ c1
        c4 = (two & c1) | (u & c2)
        two = u ^ c2
        eight |= four & c4
        four ^= c4
        if b % 16 == 12:
            over = _over(one, two, four, eight, radius)
            keep = (~over & valid[words]) != 0
            if b == 60:
                out[live] = ~over & valid[words]
            elif not keep.all():
                live, rows, words = live[keep], rows[keep], words[keep]
                one, two, four, eight = one[keep], two[keep], four[keep], eight[keep]
                if not len(live):
                    break
    return out


def _over(one, two, four, eight, radius):
    """Lanes whose count (0-7 in three counters, 8 and more in ``eight``) is over ``radius``."""
    over = eight.copy()
    for v in range(radius + 1, 8):
        hit = ~np.uint64(0)
        for plane, w in ((one, 1), (two, 2), (four, 4)):
            hit = hit & (plane if v & w else ~plane)
        over |= hit
    return over


def _find(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def local_links(bucket: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """Representative row of every row: rows of the same bucket within the radius, transitively."""
    n = len(fps)
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    f = fps[order]
    first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
    size = np.diff(np.concatenate((first, [n])))
    blocks = (size + 63) // 64
    word0 = np.concatenate(([0], np.cumsum(blocks)))[:-1]
    which = np.repeat(np.arange(len(first)), size)
    at = np.arange(n) - first[which]
    lane = (word0[which] * 64 + at).astype(np.int64)
    n_words = int(blocks.sum())
    planes = _planes(f, lane, n_words)
    row_of = np.zeros(n_words * 64, np.int64)
    row_of[lane] = np.arange(n)
    used = np.zeros(n_words * 64, np.uint8)
    used[lane] = 1
    valid = np.packbits(used, bitorder="little").view("<u8")
    # a row against its own word block and the later ones of its bucket
    own = lane // 64
    todo = np.where(size[which] > 1, word0[which] + blocks[which] - own, 0)
    parent = np.arange(n)
    ends = np.cumsum(todo)
    total = int(ends[-1]) if n else 0
    for a in range(0, total, _COMBOS):
        k = np.arange(a, min(a + _COMBOS, total))
        rows = np.searchsorted(ends, k, side="right")
        words = own[rows] + (k - (ends[rows] - todo[rows]))
        lo = parent[row_of[words * 64]]
        same = lo == parent[rows]
        if same.any():  # blocks that already hang together with the row as a whole
            cand = np.flatnonzero(same)
            lanes = row_of[(words[cand, None] * 64 + np.arange(64))]
            ok = (used[(words[cand, None] * 64 + np.arange(64))] == 0) | (parent[lanes] == parent[rows[cand], None])
            done = cand[ok.all(axis=1)]
            keep = np.ones(len(rows), bool)
            keep[done] = False
            rows, words = rows[keep], words[keep]
            if not len(rows):
                continue
        mask = _within(planes, f, rows, words, valid, radius)
        hit = np.flatnonzero(mask)
        if not len(hit):
            continue
        bits = np.unpackbits(np.ascontiguousarray(mask[hit]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        r, l = np.nonzero(bits)
        x = rows[hit[r]]
        y = row_of[words[hit[r]] * 64 + l]
        apart = x != y
        x, y = x[apart], y[apart]
        while len(x):
            px, py = parent[x], parent[y]
            apart = px != py
            if not apart.any():
                break
            x, y, px, py = x[apart], y[apart], px[apart], py[apart]
            np.minimum.at(parent, np.maximum(px, py), np.minimum(px, py))
            parent = _find(parent)
    rep = np.empty(n, np.int64)
    rep[order] = order[parent]
    return rep


# ------------------------------------------------------------------ Spark plan

def bands_for(n: int, radius: int) -> tuple[int, int]:
    """(number of bands, bands that must agree): keys get longer as the number of fingerprints grows.

    Any choice is exact; it only trades copies of a row against the rows of a key.
    """
    choose = 1 if n < 1 << 24 else 2 if n < 1 << 31 else 3
    return radius + choose, choose


def near_links(fps: DataFrame, radius: int = 4, tile: int = 4096, bands: tuple[int, int] | None = None,
               cell_rows: int = 20000) -> DataFrame:
    """Links ``(a, b)``, ``a < b``, that span every group of fingerprints within ``radius`` bits.

    ``fps``: one row per distinct fingerprint, column ``fp``.
    """
    if not 0 <= radius <= 6:
        raise ValueError("radius must be 0 to 6 bits")
    n = fps.count()
    n_bands, choose = bands or bands_for(n, radius)
    if n_bands - choose < radius:
        raise ValueError("bands - choose must be at least the radius")
    cuts = np.linspace(0, 64, n_bands + 1).round().astype(int)
    keys = []
    for k, combo in enumerate(combinations(range(n_bands), choose)):
        m = sum(((1 << int(cuts[c + 1])) - (1 << int(cuts[c]))) for c in combo)
        m = m - (1 << 64) if m >= 1 << 63 else m
        keys.append(F.struct(F.lit(k).alias("band"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")))
    rows = fps.select("fp", F.inline(F.array(*keys)))
    n_cells = max(1, -(-n * len(keys) // cell_rows))
    hot = (rows.groupBy("band", "key").count().where(F.col("count") > tile)
           .select("band", "key", F.ceil(F.col("count") / tile).cast("int").alias("tiles")))
    rows = rows.join(hot, ["band", "key"], "left")
    t = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    pairs = F.transform(F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda u: u != t),
                        lambda u: F.struct(F.least(t, u).alias("i"), F.greatest(t, u).alias("j")))
    alone = F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j")))
    rows = rows.select("fp", "band", "key", "tiles",
                       F.inline(F.when(F.col("tiles").isNull(), alone).otherwise(pairs)))
    cold = F.col("tiles").isNull()
    rows = rows.select(
        "fp", "band", "key", "i", "j",
        F.when(cold, F.pmod(F.xxhash64("band", "key"), F.lit(n_cells))).otherwise(F.col("key")).alias("cell"),
        F.when(cold, F.lit(-1)).otherwise(F.col("band")).alias("hot_band"))

    def link(table: pa.Table) -> pa.Table:
        fp = table["fp"].to_numpy()
        key = table["key"].to_numpy()
        band = table["band"].to_numpy()
        order = np.lexsort((fp, key, band))
        fp, key, band = fp[order], key[order], band[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (band[1:] != band[:-1])))
        rep = local_links(np.cumsum(new), fp.view(np.uint64), radius)
        away = rep != np.arange(len(fp))
        a, b = fp[away], fp[rep[away]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return (rows.groupBy("cell", "hot_band", "i", "j").applyInArrow(link, "a long, b long")
            .distinct())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(fp, root)``: the smallest vertex reachable over ``links (a, b)``, for every linked vertex.

    Large-star then small-star until the links stay the same.  Each half aggregates a
    minimum per vertex (combined before the shuffle) and joins it back; every round's links
    are written to the shared folder, so a lost executor costs one round.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .where("u != v").distinct(), "simhash-links")

    def mark(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        # large star: every larger neighbour of u goes to the smallest of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        # a round never has more links than the one before; few of them need few files
        edges = materialize(small.coalesce(max(1, -(-before[0] // LINKS_PER_FILE))), "simhash-links")
        after = mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components: no fixed point; raise max_rounds")
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    radius: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint``: 16 lowercase hex digits.  ``component_id``: the smallest doc_id
    reachable by links, itself included.  A null or wordless text has fingerprint zero and
    links like any other.  Rows that share an id each get their row; null ids are never the
    smallest (a group of null ids alone has a null component).  An empty table gives none.
    """
    fp, by_fp = _grouped(fingerprints(docs, id_col, text_col, shingle), radius)
    out = fp.join(by_fp, "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _grouped(fps: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """(``fps`` as a written table, ``(fp, component_id)`` of its distinct fingerprints)."""
    fp = materialize(fps, "simhash-fp")
    distinct = materialize(fp.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    root = components(near_links(distinct, radius))
    named = (distinct.join(root, "fp", "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return fp, named.join(least, "root").select("fp", "component_id")


def _text_key(text: Column) -> Column:
    """128 bits that stand for a text next to its id (null is a text of its own)."""
    return F.struct(F.xxhash64(text, F.lit(1)).alias("a"), F.xxhash64(text, F.lit(2), F.length(text)).alias("b"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
             radius: int = 4) -> DataFrame:
    """``docs`` with one row of every group: one of those with the group's smallest id; columns unchanged.

    Rows are told apart by id and text, not by id alone: rows that share an id may be in
    different groups, and each group keeps its own.  Of several rows with a group's smallest id
    one stays (with the smallest text key; if the texts are equal too, any).  Rows with a null id stay.
    """
    key, gone = fresh(docs, "text_key"), fresh(docs, "gone")
    keyed = docs.withColumn(key, _text_key(F.col(text_col)))
    marked = fingerprints(docs, id_col, text_col, shingle, also=_text_key(F.col(text_col)).alias("text_key"))
    fp, by_fp = _grouped(marked, radius)
    rows = materialize(fp.where("doc_id is not null").join(by_fp, "fp").groupBy("doc_id", "component_id", "text_key")
                       .agg(F.count(F.lit(1)).alias("n")), "simhash-rows")
    first = rows.where("doc_id = component_id").groupBy("component_id").agg(
        F.min("text_key").alias("first"), F.count(F.lit(1)).alias("texts"))
    # texts to drop: those of larger ids, and of the smallest id all but the first text
    lost = (rows.join(first.where("texts > 1").select("component_id", "first"), "component_id", "left")
            .where("component_id < doc_id or text_key > first"))
    on = lambda df: df.select(F.col("doc_id").alias(gone), F.col("text_key").alias(f"{gone}_key"))
    same = (F.col(id_col) == F.col(gone)) & (F.col(key) == F.col(f"{gone}_key"))
    kept = keyed.join(on(lost), same, "left_anti")
    again = on(rows.where("doc_id = component_id and n > 1"))
    once = kept.join(again, same, "left_anti")
    # rows that stay and are there several times: one each, reduced before the shuffle
    several = (kept.join(again, same, "left_semi").groupBy(id_col, key).agg(F.any_value(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(gone))
               .select(*[F.col(f"{gone}.`{c}`") for c in docs.columns]))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(several)
