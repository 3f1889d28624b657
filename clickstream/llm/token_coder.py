"""Adaptive context-mixing range coder for token ids, in numpy.

Ids are cut into blocks of ``BLOCK`` ids.  Every block has its own model and can be decoded
alone; many blocks run side by side as lanes of numpy arrays, one id of each lane a step.

A block begins with its alphabet: its distinct ids in order, as gaps in a Rice code, and how
often each occurs, in an Elias gamma code.  Then each id is coded by its rank there, in one
step, under a mix of three orders' predictions:

* order 0 - the counts of the ranks that are still to come in the block, brought up to date
  every ``RENEW`` ids (the counts sent less what has been coded) and scaled to parts of 4096;
* order 1 - the rank that last followed this rank, with a confidence;
* order 2 - the rank that last followed these two ranks (hashed), with a confidence.

The weights of orders 1 and 2 are adaptive hit rates by confidence (order 2's also by whether
order 1 agrees); the rest is order 0's.  Every rank's probability is the weighted sum of the
three, so all orders take part in every id.  All model arithmetic is on integers (quotients as
doubles, whose whole parts are exact here), so encoder and decoder agree on every machine.

The range coder keeps 48 bits, puts out 16 at a time and carries into digits already put out.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096
#: Lanes that run side by side; some 20 kB of model each.
LANES = 4096
MAX_ID = 1 << 32
#: Ids between two renewals of order 0.
RENEW = 1024
_TOP = np.uint64(1 << 48)
_MASK = np.uint64((1 << 48) - 1)
_LOW = np.uint64(1 << 32)
_U16, _U24, _U32 = (np.uint64(k) for k in (16, 24, 32))
_ONE = 4096        # weights and order 0's probabilities are parts of this, so a mix of _ONE * _ONE
_SLOTS = 2048      # of order 2
_EMPTY = 15        # confidence of a slot that predicts nothing
_HASH1, _HASH2, _U1 = np.uint16(12043), np.uint16(7989), np.uint16(1)
_CAP = 3968        # largest hit rate: every order keeps some weight
_GROUP = 32        # lanes renewed together, in the cache
_TABLE_IDS = 1 << 20
_HEAD = struct.Struct("<HBHHH")


class _Encoder:
    """Digits ``out[digit, lane]``, flat; ``at`` is the place of every lane's next one."""

    def __init__(self, lanes: int, cap: int):
        """``cap``: digits of a lane to begin with; :meth:`room` makes more."""
        self.lanes, self.cap = lanes, cap
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, _TOP - np.uint64(1), np.uint64)
        self.out = np.zeros(lanes * cap, np.uint32)
        self.at = np.arange(lanes)

    def narrow(self, n: int, start: np.ndarray, width: np.ndarray) -> None:
        """Take the part ``[start, start + width)`` of the first ``n`` lanes' ranges."""
        low, at = self.low[:n], self.at[:n]
        low += start
        over = (low >= _TOP).nonzero()[0]
        if len(over):
            self.out[at[over] - self.lanes] += np.uint32(1)
            low &= _MASK
        # the next digit is written in every lane, and counts in those that are narrow
        self.out[at] = low >> _U32
        narrow = width < _LOW
        shift = narrow * _U16
        at += narrow * self.lanes
        low <<= shift
        low &= _MASK
        width <<= shift
        less = (width < _LOW).nonzero()[0]
        if len(less):
            v = low[less]
            self.out[at[less]] = v >> _U32
            at[less] += self.lanes
            low[less] = (v << _U16) & _MASK
            width[less] <<= _U16
        self.range[:n] = width

    def room(self, digits: int) -> None:
        """Make sure that every lane can put out so many more digits."""
        if int(self.at.max(initial=0)) // max(1, self.lanes) + digits > self.cap:
            more = max(digits, self.cap // 4)
            self.out = np.concatenate((self.out, np.zeros(self.lanes * more, np.uint32)))
            self.cap += more

    def finish(self) -> list[bytes]:
        self.room(4)
        for k in range(3):
            self.out[self.at] = (self.low >> np.uint64(32 - 16 * k)) & np.uint64(0xFFFF)
            self.at += self.lanes
        over = np.flatnonzero(self.out > 0xFFFF)
        while len(over):  # digits carry to the left
            self.out[over] &= np.uint32(0xFFFF)
            over -= self.lanes
            self.out[over] += np.uint32(1)
            over = over[self.out[over] > 0xFFFF]
        digits = _turned(self.out.astype("<u2").reshape(self.cap, self.lanes))
        return [row[:n].tobytes() for row, n in zip(digits, (self.at // max(1, self.lanes)).tolist())]


class _Decoder:
    def __init__(self, payloads: list[bytes]):
        self.lanes = len(payloads)
        digits = np.zeros((self.lanes, max((len(x) for x in payloads), default=0) // 2 + 4), np.uint16)
        for row, x in zip(digits, payloads):
            row[:len(x) // 2] = np.frombuffer(x, "<u2", len(x) // 2)
        top = digits[:, :3].astype(np.uint64)
        self.value = (top[:, 0] << _U32) | (top[:, 1] << _U16) | top[:, 2]
        self.range = np.full(self.lanes, _TOP - np.uint64(1), np.uint64)
        self.digits = _turned(digits).ravel()
        self.at = np.arange(self.lanes) + 3 * self.lanes

    def room(self, digits: int) -> None:
        """Decoding puts nothing out."""

    def narrow(self, n: int, start: np.ndarray, width: np.ndarray) -> None:
        value, at = self.value[:n], self.at[:n]
        value -= start
        narrow = width < _LOW
        shift = narrow * _U16
        value <<= shift
        value |= self.digits.take(at, mode="clip") * narrow
        at += narrow * self.lanes
        width <<= shift
        less = (width < _LOW).nonzero()[0]
        if len(less):
            value[less] = (value[less] << _U16) | self.digits.take(at[less], mode="clip")
            at[less] += self.lanes
            width[less] <<= _U16
        self.range[:n] = width


class _Counts:
    """Order 0: each lane's counts of the ranks still to come, as scaled parts of ``_ONE``.

    ``parts`` holds every rank's part, its begin in the low and its width in the high 16 bits;
    with ``find`` also ``ranks``, the rank at each place of the parts.
    """

    def __init__(self, left: np.ndarray, find: bool):
        lanes, self.width = left.shape
        self.left = left
        self.parts = np.zeros(lanes * self.width + BLOCK, np.int32)  # an empty slot's guess can look beyond its lane
        self.ranks = np.zeros(lanes * _ONE if find else 0, np.uint16)
        self.row = np.arange(lanes) * self.width

    def renew(self, n: int, coded: np.ndarray) -> None:
        """Take ``coded[step, lane]`` off the first ``n`` lanes' counts and lay the parts out anew."""
        w = self.width
        for a in range(0, n, _GROUP):
            b = min(a + _GROUP, n)
            left = self.left[a:b]
            if len(coded):
                gone = (coded[:, a:b] + self.row[:b - a]).ravel()
                left -= np.bincount(gone, minlength=(b - a) * w).reshape(b - a, w).astype(left.dtype)
            ends = np.cumsum(left, axis=1, dtype=np.int32)
            ends = (ends * float(_ONE) / ends[:, -1:]).astype(np.int32)
            begins = np.zeros_like(ends)
            begins[:, 1:] = ends[:, :-1]
            sizes = ends - begins
            self.parts[a * w:b * w] = (begins | sizes << 16).ravel()
            if len(self.ranks):
                self.ranks[a * _ONE:b * _ONE] = np.repeat(np.tile(np.arange(w, dtype=np.uint16), b - a), sizes.ravel())


def _run(coder, sizes: np.ndarray, left: np.ndarray, ranks: np.ndarray, known: bool) -> None:
    """Code the lanes of ``ranks[step, lane]``; with ``known`` false they are filled in.

    ``sizes`` fall; ``left[lane, rank]``: how often each rank occurs.
    """
    lanes = len(sizes)
    counts = _Counts(left, not known)
    # orders 1 and 2 in one array each, as two rows of every step: slots (the rank, and in four
    # bits how sure it is) and hit rates; an empty slot guesses a rank that is none, at rate 0
    slots = np.full(lanes * (counts.width + _SLOTS), 0xFFFF, np.uint16)
    rates = np.concatenate((np.full(lanes * 32, 1200, np.int16), np.full(lanes * 32, 2000, np.int16)))
    rates.reshape(-1, 32)[:, 2 * _EMPTY:] = 0
    every = np.arange(lanes)
    slot0 = np.stack((every * counts.width, lanes * counts.width + every * _SLOTS))
    rate0 = np.stack((every, lanes + every)) * 32
    place0 = every * _ONE
    # what the two orders look at: the last rank, and a hash of the last two
    context, before = np.zeros((2, lanes), np.uint16), np.zeros(lanes, np.uint16)
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if lanes else 0), side="left")
    for t, n in enumerate(active.tolist()):
        if t % RENEW == 0:
            counts.renew(n, ranks[max(0, t - RENEW):t])
        if t % 64 == 0:
            coder.room(2 * 64 + 1)  # a step puts out two digits at most
        row = counts.row[:n]
        at = slot0[:, :n] + context[:, :n]
        x = slots.take(at)
        guess, sure = x >> 4, x & 15
        e = sure << 1
        e[1] += guess[0] == guess[1]
        e = rate0[:, :n] + e
        rate = rates.take(e)
        w2 = rate[1].astype(np.int32)
        w1 = (_ONE - w2) * rate[0] >> 12
        w0 = _ONE - w1 - w2
        w1, w2 = w1 << 12, w2 << 12
        unit = coder.range[:n] >> _U24
        if known:
            got = ranks[t, :n]
        else:
            # the guesses' extra parts lie before their own: take them off, what is left is order 0's
            own = counts.parts.take(row + guess) & 0xFFFF
            place = np.minimum(coder.value[:n] / unit, _ONE * _ONE - 1).astype(np.int32)
            place -= np.minimum(np.maximum(place - (w0 * own[0] + w2 * (guess[1] < guess[0])), 0), w1)
            place -= np.minimum(np.maximum(place - w0 * own[1], 0), w2)
            got = ranks[t, :n] = counts.ranks.take((place / w0).astype(np.int64) + place0[:n])
        part = counts.parts.take(row + got)
        hit, less = guess == got, guess < got
        start = w0 * (part & 0xFFFF) + w1 * less[0] + w2 * less[1]
        width = w0 * (part >> 16) + w1 * hit[0] + w2 * hit[1]
        coder.narrow(n, unit * start.astype(np.uint64), unit * width.astype(np.uint64))
        rates[e.ravel()] = (rate + ((hit * np.int16(_CAP) - rate) >> 4)).ravel()
        # a hit makes a slot surer by one, a miss half as sure; one that was empty or not sure at all takes the new rank
        more = sure + _U1
        new = _chosen((more & 15) < 2, got << 4, x - (more >> 1))
        slots[at.ravel()] = _chosen(hit, x + (more < _EMPTY), new).ravel()
        context[0, :n] = got
        context[1, :n] = (got * _HASH1 + before[:n]) >> 5
        before[:n] = got * _HASH2


def _chosen(which: np.ndarray, yes: np.ndarray, no: np.ndarray) -> np.ndarray:
    """``np.where`` for 16-bit numbers, by their bits."""
    return no ^ (no ^ yes) * which


def _turned(x: np.ndarray) -> np.ndarray:
    """The transpose, copied in strips that stay in the cache."""
    out = np.empty(x.shape[::-1], x.dtype)
    for a in range(0, len(out), 64):
        out[a:a + 64] = x[:, a:a + 64].T
    return out


def _gaps(x: np.ndarray) -> np.ndarray:
    """How many numbers, from 0 on, lie between one of ``x`` and the next."""
    out = x.copy()
    out[1:] -= x[:-1] + 1
    return out


def _places(sizes: np.ndarray) -> np.ndarray:
    """The place from the right of every bit, of numbers of so many bits one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(ends, sizes) - np.arange(1, (int(ends[-1]) if len(ends) else 0) + 1)


def _bits(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The last ``sizes`` bits of each value, one value after the other."""
    return (np.repeat(values, sizes) >> _places(sizes) & 1).astype(np.uint8)


def _values(bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What ``_bits`` wrote."""
    place = _places(sizes)
    sums = np.concatenate(([0], np.cumsum(bits[:len(place)].astype(np.int64) << place)))
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def _low_bits(values: np.ndarray, k: int) -> np.ndarray:
    """The last ``k`` bits of each value."""
    n = -(-k // 8)
    return np.unpackbits(values.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - n:], axis=1)[:, 8 * n - k:].ravel()


def _of_bits(bits: np.ndarray, k: int) -> np.ndarray:
    """What ``_low_bits`` wrote (with ``k`` 0, one zero for all)."""
    if not k:
        return np.zeros(1, np.int64)
    n = -(-k // 8)
    rows = np.zeros((len(bits) // k, 8 * n), np.uint8)
    rows[:, 8 * n - k:] = bits.reshape(-1, k)
    whole = np.zeros((len(rows), 4), np.uint8)
    whole[:, 4 - n:] = np.packbits(rows, axis=1)
    return whole.view(">u4").ravel().astype(np.int64)


def _unary(values: np.ndarray) -> np.ndarray:
    """Each value as so many zeros and a one."""
    ends = np.cumsum(values + 1)
    out = np.zeros(int(ends[-1]), np.uint8)
    out[ends - 1] = 1
    return out


def _pack_alphabet(letters: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct ids as gaps less one in a Rice code and their counts in a gamma code: quotients and sizes first, then the bits."""
    if not len(letters):
        return _HEAD.pack(0, 0, 0, 0, 0)
    gaps = _gaps(letters)
    k = max(0, int(np.log2(max(1.0, 0.7 * float(gaps.mean())))))
    while int((gaps >> k).sum()) > 8 * len(gaps) + 64 and k < 31:
        k += 1
    sizes = np.frexp(counts.astype(float))[1].astype(np.int64) - 1
    quotients, lengths = np.packbits(_unary(gaps >> k)).tobytes(), np.packbits(_unary(sizes)).tobytes()
    rest = np.packbits(np.concatenate((_low_bits(gaps, k), _bits(counts, sizes)))).tobytes()
    return _HEAD.pack(len(letters), k, len(quotients), len(lengths), len(rest)) + quotients + lengths + rest


def _unpack_alphabet(data: bytes, n_ids: int) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(ids, counts, what follows them); raises ``ValueError`` where they are not of a block of ``n_ids``."""
    try:
        n, k, *ends = _HEAD.unpack_from(data)
        ends = (_HEAD.size + np.cumsum([0, *ends])).tolist()
        quotients, lengths, rest = (np.unpackbits(np.frombuffer(data, np.uint8, b - a, a)) for a, b in zip(ends, ends[1:]))
        quotients, sizes = (_gaps(x.view(bool).nonzero()[0][:n]) for x in (quotients, lengths))
        low = _of_bits(rest[:n * k], k) if n else quotients
        counts = _values(rest[n * k:], sizes) + (1 << sizes)
        if len(quotients) != n or len(sizes) != n or int(counts.sum()) != n_ids:
            raise ValueError("counts")
        return np.cumsum((quotients << k | low) + 1) - 1, counts, data[ends[-1]:]
    except (struct.error, IndexError, ValueError) as e:
        raise ValueError("a block's alphabet does not match the block") from e


def _alphabet(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct ids in order, how often each occurs, each id's rank among them)."""
    s = np.sort(ids.astype(np.uint32))
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(s)), bool), s[1:] != s[:-1])))
    letters = s[first].astype(np.int64)
    counts = np.diff(first, append=len(s))
    if not len(s) or s[-1] >= _TABLE_IDS:
        return letters, counts, np.searchsorted(letters, ids)
    rank = np.empty(int(s[-1]) + 1, np.uint16)
    rank[letters] = np.arange(len(letters), dtype=np.uint16)
    return letters, counts, rank[ids]


def encode_blocks(blocks: list[np.ndarray]) -> list[tuple[bytes, int]]:
    """``(payload, checksum)`` of each block of at most ``BLOCK`` ids; the checksum is the CRC-32 of the ids as little-endian 32-bit."""
    out: list = [None] * len(blocks)
    parts = []
    for b in blocks:
        b = np.asarray(b, np.int64)
        if len(b) > BLOCK or (len(b) and (b.min() < 0 or b.max() >= MAX_ID)):
            raise ValueError(f"a block has at most {BLOCK} ids of 0 to {MAX_ID - 1}")
        parts.append(_alphabet(b))
    for order in _batches([len(p[0]) for p in parts], [len(b) for b in blocks]):
        sizes = np.array([len(blocks[i]) for i in order], np.int64)
        ranks = np.zeros((len(order), int(sizes[0])), np.uint16)
        for j, i in enumerate(order):
            ranks[j, :sizes[j]] = parts[i][2]
        coder = _Encoder(len(order), int(sizes[0]) * 5 // 8 + 8)
        _run(coder, sizes, _left([parts[i][1] for i in order]), _turned(ranks), True)
        for i, payload in zip(order, coder.finish()):
            out[i] = (_pack_alphabet(*parts[i][:2]) + payload, zlib.crc32(np.asarray(blocks[i]).astype("<u4").tobytes()))
    return out


def _left(counts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(counts), max(1, max(map(len, counts), default=1))), np.int16)
    for row, c in zip(out, counts):
        row[:len(c)] = c
    return out


def _batches(letters: list[int], sizes: list[int]) -> list[list[int]]:
    """Blocks that run together, longest first: those with alphabets of about the same size."""
    near = sorted(range(len(sizes)), key=lambda i: letters[i])
    return [sorted(near[k:k + LANES], key=lambda i: -sizes[i]) for k in range(0, len(near), LANES)]


def decode_blocks(payloads: list[bytes], sizes: list[int], checksums: list[int]) -> list[np.ndarray]:
    """Ids of each block; a block that does not match its checksum raises ``ValueError``."""
    out: list = [None] * len(payloads)
    heads = [_unpack_alphabet(x, n) for x, n in zip(payloads, sizes)]
    for order in _batches([len(h[0]) for h in heads], sizes):
        n = np.array([sizes[i] for i in order], np.int64)
        ranks = np.zeros((int(n[0]), len(order)), np.uint16)
        _run(_Decoder([heads[i][2] for i in order]), n, _left([heads[i][1] for i in order]), ranks, False)
        ranks = _turned(ranks)
        for j, i in enumerate(order):
            letters = heads[i][0]
            out[i] = letters[np.minimum(ranks[j, :sizes[i]], len(letters) - 1)].astype("<u4") if sizes[i] else np.empty(0, "<u4")
            if zlib.crc32(out[i].tobytes()) != checksums[i]:
                raise ValueError("a block does not match its checksum")
    return out
