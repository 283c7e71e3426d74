"""Token ids of whole texts, with the ``tokenizers`` library.

Byte-level BPE cuts a text into pieces before it merges, and pieces never depend on
each other. The places where a cut is certain (a lone space or line feed between two
visible characters; a letter or digit before a punctuation mark other than the
apostrophe) split a block of documents into segments with array operations; equal
segments are encoded by the library once and its ids reused. The ids are those of
``encode(text, add_special_tokens=False)``: tests compare both on random Unicode.
Where a text holds the string of an added token (``<|endoftext|>``), the library gives
that token's id and encodes what stands before and after on its own; each such string
is a segment.

Segments of up to 16 bytes are looked up by their bytes, as two words, in a hash table of
arrays; longer ones in a dictionary. Both compare all bytes, no digest stands for a
segment, and both start anew at a size in bytes.
"""

from __future__ import annotations

import os
import re
from itertools import chain

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the threads

import numpy as np  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from ._vec import Block, mix  # noqa: E402

#: Bytes of a block that is encoded at once: bounds a worker's arrays.
TOKEN_BLOCK = 1 << 20
#: Short segments that a worker remembers (about 50 bytes each), slots of their hash
#: table, and bytes of longer ones; beyond, it starts anew.
CACHE_SEGMENTS, CACHE_SLOTS, CACHE_BYTES = 600_000, 1 << 20, 8 << 20

_LETTER_DIGIT, _PUNCT, _LEAD = 1, 2, 4  # _LEAD: of two-byte characters of which none is white space
_VISIBLE = _LETTER_DIGIT | _PUNCT | 8
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = _PUNCT
_KIND[39] = 8
_KIND[48:58] = _KIND[65:91] = _KIND[97:123] = _LETTER_DIGIT
_KIND[0xC3:0xE0] = _LEAD
#: One space at most, then characters of one or two bytes that are no white space.
_PLAIN = re.compile(rb" ?(?:[!-~]|[\xc3-\xdf][\x80-\xbf])+")
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class _Known:
    """Ids of segments, by number."""

    def __init__(self) -> None:
        self.n = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)

    def add(self, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Numbers of new segments with so many of ``ids`` each."""
        used, n = int(self.start[self.n]), self.n
        while len(self.start) < n + len(count) + 1:
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        while len(self.flat) < used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[used : used + len(ids)] = ids
        self.start[n + 1 : n + 1 + len(count)] = used + np.cumsum(count)
        self.n += len(count)
        return np.arange(n, self.n)


class _Short:
    """Numbers of segments of up to 16 bytes: open addressing over arrays."""

    def __init__(self) -> None:
        self.low = np.zeros(CACHE_SLOTS, np.uint64)
        self.high = np.zeros(CACHE_SLOTS, np.uint64)
        self.tag = np.zeros(CACHE_SLOTS, np.int64)  # number and size; 0: free
        self.n = 0

    @staticmethod
    def _home(low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        h = mix(low ^ (high * np.uint64(0x9E3779B97F4A7C15)) ^ (size.astype(np.uint64) << np.uint64(57)))
        return (h & np.uint64(CACHE_SLOTS - 1)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers, -1 where a segment isn't known."""
        out, who, at = np.full(len(low), -1, np.int64), slice(None), self._home(low, high, size)
        while len(at):
            tag = self.tag[at]
            same = (self.low[at] == low[who]) & (self.high[at] == high[who]) & ((tag & 31) == size[who])
            if isinstance(who, slice):
                out = np.where(same, tag >> 5, -1)
            else:
                out[who[same]] = tag[same] >> 5
            on = np.flatnonzero(~same & (tag != 0))
            who, at = on if isinstance(who, slice) else who[on], (at[on] + 1) & (CACHE_SLOTS - 1)
        return out

    def add(self, low: np.ndarray, high: np.ndarray, size: np.ndarray, number: np.ndarray) -> None:
        """Distinct segments that aren't known yet."""
        self.n += len(low)
        at, tag = self._home(low, high, size), (number << 5) | size
        while len(at):
            free = np.flatnonzero(self.tag[at] == 0)
            self.tag[at[free]] = tag[free]  # of several for one slot the last stays
            won = self.tag[at] == tag
            self.low[at[won]], self.high[at[won]] = low[won], high[won]
            low, high, tag, at = low[~won], high[~won], tag[~won], (at[~won] + 1) & (CACHE_SLOTS - 1)


class Encoder:
    """Encodes blocks; one per worker process and vocabulary file."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or (t.normalized and self.tokenizer.normalizer) for t in added.values()):
            raise ValueError(f"{path}: added tokens that depend on the text around them")
        self.added = [t.content.encode() for t in added.values()]
        # as the library: the leftmost one, of several there the longest
        self.marker = re.compile(b"|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)))
        # a line feed is cut off between visible characters: plain segments are encoded many at a time
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else None
        self._clear()

    def _clear(self) -> None:
        self.known, self.short = _Known(), _Short()
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0

    def _encoded(self, segments: list[bytes], together: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments and how many each has; ``together`` plain ones share a call's text."""
        texts = [b"\n".join(segments[k : k + together]).decode("utf-8") for k in range(0, len(segments), together)]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum()))
        if together == 1:
            return ids, count
        # a line feed ends each segment but a text's last
        feed = ids == self.feed
        ends = np.zeros(len(ids) + 1, bool)
        ends[:-1] = feed
        ends[np.cumsum(count)] = True
        at = np.flatnonzero(ends)
        before = np.concatenate([[0], np.cumsum(feed)])[at]
        return ids[~feed], np.diff(at - before, prepend=0)

    def _learn(self, segments: list[bytes]) -> np.ndarray:
        """Numbers of segments, encoded by the library."""
        numbers = np.zeros(len(segments), np.int64)
        plain = np.fromiter((_PLAIN.fullmatch(s) is not None for s in segments), bool, len(segments)) if self.feed is not None else np.zeros(len(segments), bool)
        for own, together in ((plain, 64), (~plain, 1)):
            at = np.flatnonzero(own)
            for k in range(0, len(at), 8192):
                part = at[k : k + 8192]
                ids, count = self._encoded([segments[i] for i in part.tolist()], together)
                if len(count) != len(part):
                    raise ValueError("segments and their ids don't correspond")
                numbers[part] = self.known.add(ids, count)
        return numbers

    def _markers(self, raw: bytes, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Places of added tokens within the documents of a block."""
        if not any(t in raw for t in self.added):
            return []
        edges = offsets.tolist()
        return [m.span() for a, b in zip(edges[:-1], edges[1:]) for m in self.marker.finditer(raw, a, b)]

    def _segments(self, raw: bytes, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Edges of segments, from 0 to the block's end."""
        n = len(data)
        kind = _KIND[data]
        visible, lead = (kind & _VISIBLE) != 0, (kind & _LEAD) != 0
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        if n > 2:
            ends = visible[:-2].copy()  # byte ends a visible character
            ends[1:] |= lead[:-3]
            gap = ends & (visible[2:] | lead[2:])
            inner = data[1:-1]
            feed = gap & (inner == 10)
            cut[1 : n - 1] |= (gap & (inner == 32)) | feed
            cut[2:n] |= feed
        punct = (kind & _PUNCT) != 0
        cut[1:n] |= ((kind[:-1] & _LETTER_DIGIT) != 0) & punct[1:]
        # an accented letter before a punctuation mark (0xC3 0x97 and 0xC3 0xB7 are signs)
        after = np.flatnonzero((data[:-2] == 0xC3) & punct[2:])
        cut[after[(data[after + 1] != 0x97) & (data[after + 1] != 0xB7)] + 2] = True
        for a, b in self._markers(raw, offsets):
            cut[a + 1 : b] = False
            cut[a] = cut[b] = True
        return np.flatnonzero(cut)

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block, and each document's first (one more than documents)."""
        data, docs = block.data, len(block.offsets) - 1
        n = len(data)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(docs + 1, np.int64)
        raw = data.tobytes()
        edge = self._segments(raw, data, block.offsets)
        start, end = edge[:-1], edge[1:]
        size = end - start
        # the eight bytes from each place on, as one word; eight zeros stand before and after
        padded = np.zeros(n + 16, np.uint8)
        padded[8 : n + 8] = data
        word = np.ndarray((n + 9,), "<u8", padded.data, 0, (1,)).copy()
        low = word[start + 8] & _MASK[np.minimum(size, 8)]
        high = np.where(size > 8, word[end], np.uint64(0))
        del word, padded
        brief = size <= 16
        if self.short.n > CACHE_SEGMENTS * 9 // 10 or self.long_bytes > CACHE_BYTES:
            self._clear()
        number = np.full(len(start), -1, np.int64)
        at = np.flatnonzero(brief)
        lo, hi, sz = low[at], high[at], size[at].astype(np.uint8)
        number[at] = found = self.short.find(lo, hi, sz)
        new = np.flatnonzero(found < 0)
        if len(new):
            self._short(raw, start, at, lo, hi, sz, new, number)
        at = np.flatnonzero(~brief)
        if len(at):
            segment = [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())]
            unseen = list(dict.fromkeys(s for s in segment if s not in self.long))
            self.long.update(zip(unseen, self._learn(unseen).tolist()))
            self.long_bytes += sum(map(len, unseen))
            number[at] = np.fromiter(map(self.long.__getitem__, segment), np.int64, len(segment))
        begin = self.known.start[number]
        count = self.known.start[number + 1] - begin
        done = np.cumsum(count)
        ids = self.known.flat[np.repeat(begin - (done - count), count) + np.arange(done[-1])]
        totals = np.concatenate([[0], done])
        return ids, totals[np.searchsorted(start, block.offsets)]

    def _short(self, raw, start, at, lo, hi, sz, new, number) -> None:
        """Learns the short segments ``new`` (places in ``at``) and fills in their numbers."""
        order = new[np.lexsort((sz[new], hi[new], lo[new]))]
        first = np.ones(len(order), bool)
        first[1:] = (lo[order[1:]] != lo[order[:-1]]) | (hi[order[1:]] != hi[order[:-1]]) | (sz[order[1:]] != sz[order[:-1]])
        one = order[first]
        begin = start[at[one]].tolist()
        numbers = self._learn([raw[a : a + k] for a, k in zip(begin, sz[one].tolist())])
        number[at[order]] = numbers[np.cumsum(first) - 1]
        room = CACHE_SEGMENTS - self.short.n  # what doesn't fit is encoded again when it comes again
        self.short.add(lo[one[:room]], hi[one[:room]], sz[one[:room]], numbers[:room])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
