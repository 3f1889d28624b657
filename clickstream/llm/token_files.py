"""Token-id files: documents as ids of a public tokenizer, in coded blocks, and back.

``write_token_files`` deals the documents out in ascending id order (range partitions, sorted
inside), tokenizes them, appends an end id to each and cuts every partition's ids into blocks
that the context-mixing range coder (``token_coder``) packs.  The file format is a folder of
Parquet files, so any file system that Spark writes to will do; a row is a block:

    shard, block      place: shards follow the id order, blocks follow in a shard
    n_ids, payload    number of ids, coded ids (each block can be decoded alone)
    checksum          CRC-32 of the block's ids
    doc_ids, doc_n    the documents in the block and how many of their ids it holds
    open              the last document goes on in the next block

``read_token_files`` decodes the blocks, checks them, and gives one row per document.

Tokenization is the library's.  As its pieces never go across the pre-tokenizer's cuts, a
worker gives it every distinct cut once and remembers the ids, from task to task.  Texts stay
UTF-8 bytes in one array: the cuts of the byte-level pattern are found there by character
classes, and looked up in a hash table of numpy arrays that compares their bytes; any other
pattern is run as it is.  The strings of the file's added tokens (as ``<|endoftext|>``) get
their own ids, as in the library's default call; with ``special_text`` they are ordinary text.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickstream.llm.common import flat
from clickstream.llm.token_coder import BLOCK, LANES, decode_blocks, encode_blocks

#: Bytes of text in a shard, about.
SHARD_BYTES = 20 << 20
#: Cuts, and bytes of cuts, that a worker remembers.
MEMORY_CUTS = 1_500_000
MEMORY_BYTES = 64 << 20
_STEP_TEXT = 1 << 19
#: The pre-tokenizer pattern whose cuts are found by character classes.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4
_LIKE = ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!"))
_LONG = 64  # cuts of more bytes are looked up one by one
_PAD = np.zeros(_LONG + 8, np.uint8)
#: The first k bytes of a little-endian word.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_MIX1, _MIX2, _MIX3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
BLOCK_SCHEMA = ("shard int, block int, n_ids int, payload binary, checksum long, doc_ids array<bigint>, "
                "doc_n array<int>, open boolean")


class _Memory:
    """Numbers of the cuts met so far: a hash table with open addresses, that compares whole cuts."""

    def __init__(self):
        self.n = self.filled = 0
        self.slots = np.full(1 << 16, -1, np.int32)
        self.hash, self.head = np.zeros(1 << 14, np.uint64), np.zeros(1 << 14, np.uint64)  # head: first 8 bytes
        self.first, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.bytes = np.zeros(1 << 18, np.uint8)
        self.long: dict[bytes, int] = {}

    def look_up(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """(number of every cut ``data[first:first + size]``; an occurrence of each cut that is new, in order of their numbers)."""
        out = np.empty(len(first), np.int64)
        begin, new = self.n, []
        short = size <= _LONG
        for i in (~short).nonzero()[0].tolist():
            cut = data[first[i]:first[i] + size[i]].tobytes()
            if cut not in self.long:
                self.long[cut] = self._add(data, first[i:i + 1], size[i:i + 1], np.zeros(1, np.uint64), np.zeros(1, np.uint64))
                new.append(i)
            out[i] = self.long[cut]
        todo = short.nonzero()[0] if len(new) or not short.all() else np.arange(len(first))
        words = _words(data)
        head = words[first[todo]] & _FIRST.take(np.minimum(size[todo], 8))
        mixed = (head * _MIX1) ^ (size[todo].astype(np.uint64) * _MIX2)
        rest = (size[todo] > 8).nonzero()[0]
        at = 8
        while len(rest):
            i = todo[rest]
            mixed[rest] = (mixed[rest] ^ mixed[rest] >> np.uint64(29)) * _MIX3 ^ _word(words, first[i], size[i], at) * _MIX1
            at += 8
            rest = rest[size[i] > at]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _MIX1
        while True:
            got = self._find(words, first[todo], size[todo], head, mixed)
            out[todo] = got
            left = (got < 0).nonzero()[0]
            if not len(left):
                return out, new
            # one of each hash is learned; others of that hash are looked up again
            one = left[np.unique(mixed[left], return_index=True)[1]]
            i = todo[one]
            self._place(self._add(data, first[i], size[i], head[one], mixed[one]) + np.arange(len(one)))
            new += i.tolist()
            todo, head, mixed = todo[left], head[left], mixed[left]

    def _find(self, words, first, size, head, mixed) -> np.ndarray:
        """Numbers of short cuts, -1 for those that are not there."""
        known = _words(self.bytes)
        slot = self._slot(mixed)
        out = self.slots.take(slot).astype(np.int64)
        todo = np.arange(len(out))
        same = (self.head.take(out) == head) & (self.size.take(out) == size)  # -1 reads the last: no matter
        at = 8
        rest = (same & (size > 8)).nonzero()[0]
        while True:
            while len(rest):
                i = todo[rest]
                differs = _word(known, self.first[out[i]], size[i], at) != _word(words, first[i], size[i], at)
                same[rest[differs]] = False
                at += 8
                rest = rest[~differs & (size[i] > at)]
            todo = todo[~same & (out[todo] >= 0)]
            if not len(todo):
                return out
            slot[todo] = (slot[todo] + 1) & (len(self.slots) - 1)
            n = self.slots.take(slot[todo]).astype(np.int64)
            out[todo] = n
            same = (self.head.take(n) == head[todo]) & (self.size.take(n) == size[todo])
            at = 8
            rest = (same & (size[todo] > 8)).nonzero()[0]

    def _slot(self, mixed: np.ndarray) -> np.ndarray:
        return (mixed >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _add(self, data, first, size, head, mixed) -> int:
        """The first number of these cuts."""
        n, k, total = self.n, len(first), int(size.sum())
        while n + k > len(self.first):
            for name in ("hash", "head", "first", "size"):
                setattr(self, name, _doubled(getattr(self, name)))
        while self.filled + total + len(_PAD) > len(self.bytes):
            self.bytes = _doubled(self.bytes)
        ends = np.cumsum(size)
        self.bytes[self.filled:self.filled + total] = data[np.repeat(first - (ends - size), size) + np.arange(total)]
        self.hash[n:n + k], self.head[n:n + k] = mixed, head
        self.first[n:n + k], self.size[n:n + k] = self.filled + ends - size, size
        self.n, self.filled = n + k, self.filled + total
        return n

    def _place(self, numbers: np.ndarray) -> None:
        if 2 * self.n > len(self.slots):
            self.slots = np.full(4 * len(self.slots), -1, np.int32)
            numbers = (self.size[:self.n] <= _LONG).nonzero()[0]
        slot = self._slot(self.hash[numbers])
        while len(numbers):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = numbers[free]
            left = self.slots[slot] != numbers
            numbers, slot = numbers[left], (slot[left] + 1) & (len(self.slots) - 1)


def _doubled(x: np.ndarray) -> np.ndarray:
    return np.concatenate((x, np.zeros_like(x)))


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every byte on as a little-endian number."""
    return np.ndarray(len(data) - 7, "<u8", data, strides=(1,))


def _word(words: np.ndarray, first: np.ndarray, size: np.ndarray, at: int) -> np.ndarray:
    """The word ``at`` bytes on, without what is beyond the size."""
    return words[first + at] & _FIRST.take(np.minimum(size - at, 8))


def _byte_letters() -> np.ndarray:
    """The byte-level alphabet: printable bytes as they are, the others from code point 256 on."""
    out = np.arange(256, dtype="<u4")
    others = [b for b in range(256) if b not in {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}]
    out[others] = 256 + np.arange(len(others))
    return out


class Tokenizer:
    """One tokenizer file with the ids of the cuts met so far (``pool`` holds them one after the other)."""

    def __init__(self, path: str, pattern: str, special_text: bool = False):
        """``special_text``: the strings of special tokens are ordinary text, else they get their ids."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer as Library
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Library.from_file(path)
        self.library.encode_special_tokens = special_text
        self.by_class = pattern == BYTE_LEVEL
        self.findall = regex.compile(pattern).findall
        added = [t for t in self.library.get_added_tokens_decoder().values() if t.content and not (special_text and t.special)]
        #: Added tokens found as they stand; where some look at their surroundings, the library gets those texts whole.
        self.plain = self.library.normalizer is None and not any(t.lstrip or t.rstrip or t.single_word for t in added)
        names = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, names))) if names else None
        #: With the byte-level pre-tokenizer a cut's ids are the model's of its bytes as letters, and the cuts are made by its classes.
        pre = self.library.pre_tokenizer
        self.direct = (self.by_class and self.plain and isinstance(pre, ByteLevel) and pre.use_regex and not pre.add_prefix_space
                       and self.library.truncation is None and self.library.padding is None)
        self.whole = {t.content.encode(): i for i, t in self.library.get_added_tokens_decoder().items()}
        self.letters = _byte_letters()
        #: Class of every character, 0 where it has not been met.
        self.classes = np.zeros(0x110000, np.uint8)
        self.match_class = regex.compile(r"(\p{L})|(\p{N})|(\s)|([^\s\p{L}\p{N}])", regex.DOTALL).match
        self._classify(np.arange(128))
        self.ascii = np.concatenate((self.classes[:128], np.full(128, _OTHER, np.uint8)))
        self._forget()

    def _forget(self) -> None:
        self.memory = _Memory()
        self.pool = np.empty(1 << 16, np.int32)
        self.filled = 1  # the end id comes first
        self.first = np.zeros(1 << 14, np.int64)
        self.size = np.ones(1 << 14, np.int64)

    def _classify(self, chars: np.ndarray) -> None:
        if self.direct:  # what the pre-tokenizer leaves together with a letter, a number, another sign
            cuts = self.library.pre_tokenizer.pre_tokenize_str
            for c in chars.tolist():
                self.classes[c] = next((k for k, x in _LIKE if len(cuts(x + chr(c))) == 1), _SPACE)
            return
        for c in chars.tolist():
            m = self.match_class(chr(c))
            self.classes[c] = m.lastindex if m else _OTHER

    def _kinds(self, data: np.ndarray) -> np.ndarray:
        """The class of every byte's character."""
        kind = self.ascii.take(data)
        lead = (data >= 0xC0).nonzero()[0]
        if len(lead):
            b = data[lead[:, None] + np.arange(4)].astype(np.int64)
            two, three = b[:, 0] < 0xE0, b[:, 0] < 0xF0
            char = np.where(two, (b[:, 0] & 31) << 6 | b[:, 1] & 63, (b[:, 0] & 15) << 12 | (b[:, 1] & 63) << 6 | b[:, 2] & 63)
            four = (~three).nonzero()[0]
            char[four] = (b[four, 0] & 7) << 18 | (b[four, 1] & 63) << 12 | (b[four, 2] & 63) << 6 | b[four, 3] & 63
            char = np.minimum(char, len(self.classes) - 1)
            k = self.classes[char]
            if not k.all():
                self._classify(np.unique(char[k == 0]))
                k = self.classes[char]
            kind[lead] = kind[lead + 1] = k
            kind[lead[~two] + 2] = k[~two]
            kind[lead[four] + 3] = k[four]
        return kind

    def _starts(self, data: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """Where the cuts of the byte-level pattern begin.  ``texts``: where texts begin, and the end; ``data`` is padded."""
        n = int(texts[-1])
        kind = self._kinds(data)
        data, kind = data[:n + 4], kind[:n + 4]
        new = np.zeros(n + 4, bool)
        new[texts] = True
        start = new.copy()
        start[1:] |= kind[1:] != kind[:-1]
        # the last white space before something else is a cut of its own, or a blank that goes with it
        space = kind == _SPACE
        last = space[:-1] & ~(space[1:] | new[1:])
        blank = last & (data[:-1] == 0x20)
        start[:-1] |= last
        start[1:] &= ~blank
        wide = (last & (data[:-1] >= 0x80)).nonzero()[0]
        start[wide] = False
        while len(wide):
            inside = (data[wide] & 0xC0) == 0x80
            start[wide[~inside]] = True
            wide = wide[inside] - 1
        # 's 't 'm 'd 're 've 'll, where a cut begins with the apostrophe
        q = (data[:n] == 0x27).nonzero()[0]
        before = np.maximum(q - 1, 0)
        q = q[(new[q] | ((kind[before] != _OTHER) & (data[before] != 0x20))) & ~new[q + 1]]
        a, b = data[q + 1], data[q + 2]
        one = q[(a == 0x73) | (a == 0x74) | (a == 0x6D) | (a == 0x64)]
        two = q[~new[q + 2] & (((a == 0x72) & (b == 0x65)) | ((a == 0x76) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C)))]
        start[one + 1] = start[two + 1] = False
        start[one + 2] = start[two + 3] = True
        return start[:n].nonzero()[0]

    def _cuts(self, data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(data, where its cuts begin, and the end; where texts begin, and the end).

        Pieces that can be encoded one by one: added tokens, and the pre-tokenizer's cuts of what is between.
        """
        raw = data[:int(texts[-1])].tobytes()
        whole = []  # pieces that stay whole
        if self.added is not None and self.added.search(raw):
            for a, b in zip(texts[:-1].tolist(), texts[1:].tolist()):
                found = [m.span() for m in self.added.finditer(raw, a, b)]
                whole += found if self.plain or not found else [(a, b)]
        whole = np.array(whole, np.int64).reshape(-1, 2)
        parts = np.unique(np.concatenate((texts, whole.ravel())))
        if self.by_class:
            starts = self._starts(data, parts)
            if len(whole):
                inside = np.zeros(len(raw) + 1, np.int64)
                np.add.at(inside, whole[:, 0] + 1, 1)
                np.add.at(inside, whole[:, 1], -1)
                starts = starts[np.cumsum(inside)[starts] == 0]
            return data, np.append(starts, texts[-1]), texts
        kept = set(whole[:, 0].tolist())
        cuts: list[bytes] = []
        stops = {0: 0}
        size = 0
        for a, b in zip(parts[:-1].tolist(), parts[1:].tolist()):
            got = [raw[a:b]] if a in kept else [x.encode() for x in self.findall(raw[a:b].decode())]
            cuts += got
            size += sum(map(len, got))
            stops[b] = size
        cuts = [x for x in cuts if x]
        return (np.concatenate((np.frombuffer(b"".join(cuts), np.uint8), _PAD)), np.cumsum([0, *map(len, cuts)]),
                np.array([stops[t] for t in texts.tolist()], np.int64))

    def _learn(self, cuts: list[bytes]) -> None:
        text = b"".join(cuts)
        if self.direct:
            text.decode()  # raises where a text is not UTF-8
            letters = self.letters[np.frombuffer(text, np.uint8)].tobytes().decode("utf-32-le")
            ends = np.cumsum([len(x) for x in cuts]).tolist()
            pieces, model = self.whole, self.library.model.tokenize
            got = [[pieces[x]] if x in pieces else [y.id for y in model(letters[b - len(x):b])] for x, b in zip(cuts, ends)]
        else:
            got = [e.ids for e in self.library.encode_batch([x.decode() for x in cuts], add_special_tokens=False)]
        counts = np.array([len(x) for x in got], np.int64)
        ids = np.array(list(chain.from_iterable(got)), np.int32)
        n, k = self.memory.n - len(cuts) + 1, len(cuts)
        while n + k > len(self.first):
            self.first, self.size = _doubled(self.first), _doubled(self.size)
        while self.filled + len(ids) > len(self.pool):
            self.pool = _doubled(self.pool)
        self.pool[self.filled:self.filled + len(ids)] = ids
        self.first[n:n + k] = self.filled + np.cumsum(counts) - counts
        self.size[n:n + k] = counts
        self.filled += len(ids)

    def encode(self, texts: list[str | None] | pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each with ``end_id`` after it; number of ids of each text)."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if not len(texts):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        texts = texts.fill_null("").cast(pa.large_binary())
        _, offsets, buffer = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(buffer, np.uint8)[ends[0]:ends[-1]] if buffer is not None else _PAD[:0]
        data, cuts, ends = self._cuts(np.concatenate((data, _PAD)), ends - ends[0])
        if self.memory.n > MEMORY_CUTS or self.memory.filled > MEMORY_BYTES:
            self._forget()
        first, size = cuts[:-1], np.diff(cuts)
        at, new = self.memory.look_up(data, first, size)
        if new:
            raw = data.tobytes()
            self._learn([raw[a:a + n] for a, n in zip(first[new].tolist(), size[new].tolist())])
        self.pool[0] = end_id
        stops = np.searchsorted(cuts, ends[1:])  # cuts up to each text's end
        at = np.insert(at + 1, stops, 0)
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.first[at] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        return ids, np.diff(ends[stops + np.arange(len(stops))], prepend=0)


_LOADED: dict[tuple, Tokenizer] = {}


def _tokenizer(path: str, *how) -> Tokenizer:
    """The worker's tokenizer of this file, with what it remembers from earlier tasks."""
    file = os.stat(path)
    key = (path, file.st_mtime_ns, file.st_size, *how)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizer(path, *how)
    return _LOADED[key]


class _ShardWriter:
    """Cuts a shard's documents into blocks."""

    def __init__(self, shard: int):
        self.shard, self.block = shard, 0
        self.ids: list[np.ndarray] = []
        self.docs: list[int | None] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, docs: list, ids: np.ndarray, counts: np.ndarray) -> None:
        self.docs += docs
        self.ids.append(ids)
        self.counts.append(counts)
        self.held += len(ids)

    def rows(self, last: bool) -> Iterator[pa.RecordBatch]:
        """The full blocks held (with ``last``, all), coded together."""
        ids, counts = flat(self.ids, np.int32), flat(self.counts, np.int64)
        take = len(ids) if last else len(ids) // BLOCK * BLOCK
        if not take:
            return
        ends = np.cumsum(counts)
        starts = np.arange(0, take, BLOCK)
        stops = np.minimum(starts + BLOCK, take)
        coded = encode_blocks([ids[a:b] for a, b in zip(starts, stops)])
        names, sizes, opens = [], [], []
        for a, b in zip(starts.tolist(), stops.tolist()):
            i, j = int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(ends, b, side="left"))
            edge = np.concatenate(([a], np.minimum(ends[i:j + 1], b)))
            names.append(self.docs[i:j + 1])
            sizes.append(np.diff(edge).tolist())
            opens.append(bool(ends[j] > b))
        n = len(starts)
        yield pa.record_batch({
            "shard": pa.array([self.shard] * n, pa.int32()), "block": pa.array(range(self.block, self.block + n), pa.int32()),
            "n_ids": pa.array((stops - starts).astype(np.int32)), "payload": pa.array([x for x, _ in coded], pa.binary()),
            "checksum": pa.array([c for _, c in coded], pa.int64()), "doc_ids": pa.array(names, pa.list_(pa.int64())),
            "doc_n": pa.array(sizes, pa.list_(pa.int32())), "open": pa.array(opens)})
        self.block += n
        done = int(np.searchsorted(ends, take, side="right"))  # documents that are written whole
        left = counts[done:].copy()
        if len(left):
            left[0] = ends[done] - take
        self.docs, self.ids, self.counts, self.held = self.docs[done:], [ids[take:]], [left], len(ids) - take


def write_token_files(docs: DataFrame, path: str, tokenizer: str, pattern: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", shard_bytes: int = SHARD_BYTES, special_text: bool = False) -> None:
    """Write the ids of every text (null counts as empty) in ascending id order, null ids first.

    The ids are those of the library's default call: added tokens in a text get their ids
    (``special_text``: those of special tokens are ordinary text instead).

    Rows that share an id follow each other by text.  ``tokenizer``: a tokenizer file, at the
    same place on every machine; ``pattern``: its pre-tokenizer's regular expression.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(1, -(-size // shard_bytes))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer, pattern, special_text)
        out = _ShardWriter(TaskContext.get().partitionId())
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_string())
            size = np.cumsum(pc.binary_length(texts).to_numpy())
            edges = np.flatnonzero(np.diff(size // _STEP_TEXT)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(names)]):
                out.add(names[a:b], *tok.encode(texts[a:b], end_id))
                if out.held >= LANES * BLOCK:
                    yield from out.rows(last=False)
        yield from out.rows(last=True)

    rows.mapInArrow(write, BLOCK_SCHEMA).write.mode("overwrite").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in a folder of token files.

    ``start``: number of ids of all documents before it.  A shard's blocks are decoded in
    order by one task (a shard has a bounded size); shards' starts are a running sum over one
    row per shard.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = shards.select(F.col("shard").alias("s"), F.coalesce(before, F.lit(0)).alias("first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at, doc = None, 0, None
        for got in _decoded(batches):
            rows = []
            for s, ids, names, sizes, goes_on in got:
                if s != shard:
                    shard, at, doc = s, 0, None
                raw = ids.tobytes()
                p = 0
                for k, (name, n) in enumerate(zip(names, sizes)):
                    if doc is None:
                        doc = [name, at, 0, 0]
                    doc[2] += n
                    doc[3] = zlib.crc32(raw[4 * p:4 * (p + n)], doc[3])
                    p += n
                    at += n
                    if k + 1 < len(names) or not goes_on:
                        rows.append((shard, *doc))
                        doc = None
            cols = list(zip(*rows)) or [[], [], [], [], []]
            yield pa.record_batch({"shard": pa.array(cols[0], pa.int32()), **{
                k: pa.array(c, pa.int64()) for k, c in zip(("doc_id", "at", "n_tokens", "ids_crc32"), cols[1:])}})

    n = max(1, shards.count())
    docs = (blocks.repartition(n, "shard").sortWithinPartitions("shard", "block")
            .mapInArrow(read, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long"))
    return (docs.join(starts, F.col("shard") == F.col("s"))
            .select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of blocks with their ids, up to ``LANES`` blocks decoded together."""
    held: list[dict] = []

    def flush():
        ids = decode_blocks([r["payload"] for r in held], [r["n_ids"] for r in held], [r["checksum"] for r in held])
        got = [(r["shard"], x, r["doc_ids"], r["doc_n"], r["open"]) for r, x in zip(held, ids)]
        held.clear()
        return got

    for batch in batches:
        for row in batch.to_pylist():
            held.append(row)
            if len(held) == LANES:
                yield flush()
    if held:
        yield flush()
