"""SentencePiece encoding and decoding by a batched numpy Viterbi.

The pieces and scores come from a given SentencePiece model file; nothing is trained and the
library is used only to read the file.  A text is segmented into the pieces with the largest
total score (the unigram rule), escaped as the library does: spaces become U+2581, one is
put in front, and characters without a piece become byte pieces.

Texts are cut into words (a run of U+2581 and what follows up to the next run; no piece goes
across such a cut).  Distinct words that are not remembered yet are grouped by length, and
all words of one length advance together: for each end position and each piece length the
substring hashes (differences of prefix hashes) are looked up in the sorted piece keys, and
a running maximum keeps the best score and its backpointer.  A hash that meets is confirmed
on the characters, so no collision can give a piece.

Ties in the total go to the longer last piece, as in the library.

Decoding is the exact inverse: piece texts with U+2581 read as spaces, byte pieces as bytes,
the first space dropped.  A U+2581 that is in the text itself is written as byte pieces, so
that it comes back as it was.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from clickstream.llm.common import by_size, flat

SPACE = "▁"
#: Stands for a U+2581 of the text while it is segmented: a lone surrogate, which no valid text holds.
_LITERAL = "\ud800"
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_MULT = np.uint64(0x9E3779B97F4A7C15)
#: Score below the smallest piece of characters that no piece covers (the library's penalty).
UNKNOWN_PENALTY = 10.0
#: Distinct words remembered by a worker, and characters segmented in one step.
MEMORY_WORDS = 400_000
STEP_CHARS = 1 << 19
#: Characters of text encoded together (longer texts alone).
STEP_TEXT = 1 << 21


class PieceModel:
    """Pieces of a model, sorted by (length, hash) for probing."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int], unknown_id: int):
        """``pieces``: text and score by id ("" for ids that are never matched); ``byte_ids``: 256 ids."""
        self.texts = [p for p, _ in pieces]
        self.unknown_id = unknown_id
        self.byte_ids = byte_ids
        usable = [(p, i, s) for i, (p, s) in enumerate(pieces) if p]
        if SPACE not in self.texts:
            raise ValueError("the model has no piece for a space")
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in usable):
            raise ValueError("a piece goes across a word start; this model cannot be cut into words")
        self.longest = max(len(p) for p, _, _ in usable)
        self.unknown_score = min(s for _, _, s in usable) - UNKNOWN_PENALTY
        self.keys, self.ids, self.scores, self.chars = [None], [None], [None], [None]
        for n in range(1, self.longest + 1):
            own = [(p, i, s) for p, i, s in usable if len(p) == n]
            codes = _codes([p for p, _, _ in own], n)
            h = _prefix_hashes(codes)[:, -1] if own else np.empty(0, np.uint64)
            order = np.argsort(h)
            self.keys.append(h[order])
            self.ids.append(np.array([i for _, i, _ in own], np.int32)[order])
            self.scores.append(np.array([s for _, _, s in own], np.float64)[order])
            self.chars.append(codes[order])
            if len(np.unique(h)) != len(h):
                raise ValueError("two pieces share a hash")  # probing would miss one of them
        steps = np.full(self.longest + 1, _MULT, np.uint64)
        steps[0] = 1
        self.power = np.cumprod(steps)
        out = [p.replace(SPACE, " ").encode() for p in self.texts]
        for b, i in enumerate(byte_ids):
            out[i] = bytes([b])
        self.raw = out

    @classmethod
    def from_file(cls, path: str) -> PieceModel:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = []
        byte_ids = [-1] * 256
        for i in range(sp.get_piece_size()):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(text[1:-1], 16)] = i
            plain = not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
            pieces.append((text if plain else "", sp.get_score(i)))
        if min(byte_ids) < 0:
            raise ValueError("a model with byte pieces is needed: decoding has to be exact")
        return cls(pieces, byte_ids, sp.unk_id())

    def _bytes(self, char: str) -> list[int]:
        """Byte pieces of a character, last first."""
        return [self.byte_ids[b] for b in reversed((SPACE if char == _LITERAL else char).encode())]

    # ------------------------------------------------------------ words of one length

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids, in a row, of words that all have the same length; and how many each word has."""
        m, n = len(words), len(words[0])
        codes = _codes(words, n)
        hashes = _prefix_hashes(codes)
        best = np.full((n + 1, m), -np.inf)
        best[0] = 0.0
        back_len = np.ones((n + 1, m), np.int16)
        back_id = np.full((n + 1, m), -1, np.int32)
        for end in range(1, n + 1):
            # an uncovered character is one step of its own
            score = best[end - 1] + self.unknown_score
            size, ids = back_len[end], back_id[end]
            for k in range(1, min(end, self.longest) + 1):
                keys = self.keys[k]
                if not len(keys):
                    continue
                h = hashes[:, end] - hashes[:, end - k] * self.power[k]
                at = np.searchsorted(keys, h)
                at[at == len(keys)] = 0
                hit = np.flatnonzero(keys[at] == h)
                if not len(hit):
                    continue
                at = at[hit]
                same = (self.chars[k][at] == codes[hit, end - k:end]).all(axis=1)
                hit, at = hit[same], at[same]
                total = best[end - k][hit] + self.scores[k][at]
                better = total >= score[hit]  # pieces get longer, so the longer one wins a tie
                hit, at = hit[better], at[better]
                score[hit] = total[better]
                size[hit] = k
                ids[hit] = self.ids[k][at]
            best[end] = score
        return self._walk_back(words, back_len, back_id)

    def _walk_back(self, words, back_len, back_id) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has, from the backpointers."""
        who, got, at = [], [], []
        place = np.full(len(words), len(words[0]))
        live = np.arange(len(words))
        while len(live):
            here = place[live]
            who.append(live)
            got.append(back_id[here, live])
            at.append(here)
            place[live] = here - back_len[here, live]
            live = live[place[live] > 0]
        who, got, at = np.concatenate(who), np.concatenate(got), np.concatenate(at)
        order = np.lexsort((at, who))
        who, got, at = who[order], got[order], at[order]
        bare = np.flatnonzero(got < 0)
        if len(bare):  # uncovered characters become their bytes
            raw = [self._bytes(words[w][p - 1])[::-1] for w, p in zip(who[bare].tolist(), at[bare].tolist())]
            times = np.ones(len(got), np.int64)
            times[bare] = [len(b) for b in raw]
            who, fill = np.repeat(who, times), np.repeat(got < 0, times)
            got = np.repeat(got, times)
            got[fill] = [x for b in raw for x in b]
        return got, np.bincount(who, minlength=len(words))

    def segment_long(self, word: str) -> list[int]:
        """One long word: all matches per length at once, then one walk over them (same rule, same ties)."""
        n = len(word)
        codes = _codes([word], n)[0]
        best = [0.0] + [-np.inf] * n
        size, ids = [1] * (n + 1), [-1] * (n + 1)
        for a in range(0, n, 1 << 16):
            lo, hi = max(0, a - self.longest + 1), min(n, a + (1 << 16))
            part = codes[lo:hi]
            hashes = _prefix_hashes(part[None])[0]
            ends, lens, pids, scores = [], [], [], []
            for k in range(1, min(self.longest, len(part)) + 1):
                keys = self.keys[k]
                if not len(keys):
                    continue
                h = hashes[k:] - hashes[:-k] * self.power[k]
                at = np.searchsorted(keys, h)
                at[at == len(keys)] = 0
                hit = np.flatnonzero(keys[at] == h)
                at = at[hit]
                same = (self.chars[k][at] == np.lib.stride_tricks.sliding_window_view(part, k)[hit]).all(axis=1)
                hit, at = hit[same], at[same]
                end = hit + k + lo
                new = end > a  # earlier ends were walked with the part before
                ends.append(end[new])
                lens.append(np.full(int(new.sum()), k))
                pids.append(self.ids[k][at[new]])
                scores.append(self.scores[k][at[new]])
            end = np.concatenate(ends) if ends else np.empty(0, np.int64)
            order = np.argsort(end, kind="stable")  # shorter pieces first at each end
            edges = zip(*(np.concatenate(x)[order].tolist() for x in (ends, lens, pids, scores))) if len(end) else iter(())
            edge = next(edges, None)
            for e in range(a + 1, hi + 1):
                top = best[e - 1] + self.unknown_score
                while edge is not None and edge[0] == e:
                    total = best[e - edge[1]] + edge[3]
                    if total >= top:
                        top, size[e], ids[e] = total, edge[1], edge[2]
                    edge = next(edges, None)
                best[e] = top
        out, p = [], n
        while p:
            if ids[p] >= 0:
                out.append(ids[p])
            else:
                out.extend(self._bytes(word[p - 1]))
            p -= size[p]
        out.reverse()
        return out


def _codes(words: list[str], n: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), n)


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """``h[:, j]``: polynomial hash of the first j characters, modulo 2**64."""
    m, n = codes.shape
    out = np.zeros((m, n + 1), np.uint64)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(31)
    for j in range(n):
        out[:, j + 1] = out[:, j] * _MULT + mixed[:, j]
    return out


class Encoder:
    """Encodes texts with one model, remembering the words it has segmented.

    The ids of remembered words lie one after the other in ``pool``; a text's ids are
    gathered from there by its words' numbers.
    """

    #: Longer words take the walk of their own.
    LONG = 64

    def __init__(self, model: PieceModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.pool = np.empty(1 << 16, np.int32)
        self.first = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.filled = 0

    def words(self, text: str) -> list[str]:
        return _WORDS.findall(SPACE + text.replace(SPACE, _LITERAL).replace(" ", SPACE))

    def _learn(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        n, k = len(self.number), len(words)
        while n + k > len(self.first):
            self.first = np.concatenate((self.first, np.zeros_like(self.first)))
            self.size = np.concatenate((self.size, np.zeros_like(self.size)))
        while self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.empty_like(self.pool)))
        self.pool[self.filled:self.filled + len(ids)] = ids
        self.first[n:n + k] = self.filled + np.cumsum(counts) - counts
        self.size[n:n + k] = counts
        self.filled += len(ids)
        self.number.update(zip(words, range(n, n + k)))

    def flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text); null and empty texts have none."""
        cut = [self.words(t) if t else [] for t in texts]
        every = set().union(*cut) if cut else set()
        new = every - self.number.keys()
        if len(self.number) + len(new) > MEMORY_WORDS:
            self._forget()
            new = every
        by_len: dict[int, list[str]] = {}
        for w in new:
            by_len.setdefault(len(w), []).append(w)
        for n, group in by_len.items():
            if n > self.LONG:
                for w in group:
                    ids = self.model.segment_long(w)
                    self._learn([w], np.array(ids, np.int32), np.array([len(ids)]))
                continue
            step = max(1, STEP_CHARS // (n * 8))
            for a in range(0, len(group), step):
                self._learn(group[a:a + step], *self.model.segment(group[a:a + step]))
        n_words = np.array([len(ws) for ws in cut], np.int64)
        at = np.fromiter((k for ws in cut for k in map(self.number.__getitem__, ws)), np.int64, int(n_words.sum()))
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(self.first[at] - (ends - sizes), sizes) + np.arange(total)]
        ends = np.concatenate(([0], ends))
        stops = np.concatenate(([0], np.cumsum(n_words)))
        return ids, np.diff(ends[stops])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        ids, counts = self.flat(texts)
        return np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []


def decode(model: PieceModel, ids) -> str:
    """The text of a sequence of ids (the inverse of ``Encoder.encode``)."""
    raw = model.raw
    got = b"".join(map(raw.__getitem__, ids))
    return (got[1:] if got[:1] == b" " else got).decode("utf-8", "replace")


_MODELS: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """The model of a path, read once by each worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel.from_file(path)
    return _MODELS[path]


def encode_column(text: Column, path: str) -> Column:
    """Ids (``array<int>``) of a text column; null and empty texts give an empty array.

    ``path``: the model file, at the same place on every machine (as an installed package is).
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(load(path))
        for arr in batches:
            texts = arr.to_pylist()
            got = [encoder.flat(texts[a:b]) for a, b in by_size(texts, STEP_TEXT)]
            counts = flat((c for _, c in got), np.int64)
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat((x for x, _ in got), np.int32)))

    return encode(text)


def decode_column(ids: Column, path: str) -> Column:
    """Texts of an ids column; null ids give null."""

    @F.arrow_udf("string")
    def back(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load(path)
        for arr in batches:
            values = arr.flatten().to_numpy(zero_copy_only=False)
            sizes = arr.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            stop = np.cumsum(sizes).tolist()
            yield pa.array([None if gone else decode(model, values[b - n:b].tolist()) for gone, n, b in
                            zip(arr.is_null().to_pylist(), sizes.tolist(), stop)], pa.string())

    return back(ids)
