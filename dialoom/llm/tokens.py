"""Token ids of whole texts with a public tokenizer, given as the path of its file.

The pre-tokenizers used here never join characters over the start of a run of white space, nor an ASCII
letter or digit with ASCII punctuation after it (the apostrophe aside). A text is cut at these places, and its
ids are those of its pieces. Each distinct piece is encoded once by the library and kept with its bytes; it is found by a
64-bit hash, in a table with open addressing, and then compared byte by byte, and pieces whose hash another has are kept beside. Where ids
keep all bytes of a text, many new pieces are encoded as one text, and their bytes show where each one's ids end. The store starts anew when it is full. A text with other
white space than ASCII's is one piece, as a run could be cut within, and so is one that holds the string of an
added token ('<|endoftext|>'), which the library gives that token's id.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from dialoom.llm.wordhash import SPACE, at_eight, buffer, eights, span_hashes, trim, windows

#: Pieces, ids and bytes of pieces kept by a process: about 24 bytes for a piece and 6 to 16 of the table, 4 for an id.
MOST_PIECES, MOST_IDS, MOST_BYTES = 1_200_000, 8_000_000, 24_000_000
#: New pieces that are encoded as one text at most, where that can be undone.
JOINED = 64

#: Bytes' kinds: 1 white space, 2 ASCII punctuation but the apostrophe, 4 an ASCII letter or digit.
_KINDS = bytes(1 if SPACE[c] else 4 if c < 128 and chr(c).isalnum() else 2 if 33 <= c < 127 and c != 39 else 0 for c in range(256))


def _wide_space(data: np.ndarray) -> np.ndarray:
    """Places of white space beyond ASCII: U+0085, 00A0, 1680, 2000-200A, 2028, 2029, 202F, 205F, 3000."""
    at = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if not len(at):
        return at
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = (padded[at + k].astype(np.int64) for k in range(3))
    three = (a << 16) | (b << 8) | c
    hit = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    hit |= (three >= 0xE28080) & (three <= 0xE2808A)
    hit |= np.isin(three, [0xE19A80, 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])
    return at[hit]


class Encoder:
    _open: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kinds = self.tokenizer.get_added_tokens_decoder().values()
        # where one is sought in normalised text, no text is cut: its string may look different before
        added = "" if any(t.normalized for t in kinds) else "|".join(sorted(re.escape(t.content) for t in kinds))
        self.added = re.compile(added.encode()) if kinds else None
        self.bytes_of = self._bytes_of()
        self.clear()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One for each process and file."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    @classmethod
    def forget(cls) -> None:
        """Give up those of this process."""
        if cls._open:
            cls._open.clear()
            trim()

    def _bytes_of(self) -> np.ndarray | None:
        """How many bytes of a text each id stands for, where ids keep them all: then they show where joined pieces end."""
        from tokenizers import pre_tokenizers

        t = self.tokenizer
        if t.normalizer is not None or t.truncation or t.padding or not isinstance(t.pre_tokenizer, pre_tokenizers.ByteLevel) or t.pre_tokenizer.add_prefix_space:
            return None
        words = t.get_vocab()
        out = np.zeros(max(words.values(), default=0) + 1, np.int32)
        out[np.fromiter(words.values(), np.int64, len(words))] = np.fromiter(map(len, words), np.int32, len(words))  # a character for each byte
        return out

    def clear(self) -> None:
        self.table = np.full(1 << 15, -1, np.int32)  # places of pieces by hash, -1 where there is none
        self.hash = np.zeros(1 << 14, np.uint64)
        self.begin = np.zeros(1 << 14, np.int32)
        self.size = np.zeros(1 << 14, np.int32)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.text = np.zeros(1 << 16, np.uint8)  # their bytes, and where each piece's begin and end
        self.text_at = np.zeros(1 << 14, np.int32)
        self.text_to = np.zeros(1 << 14, np.int32)
        self.size[0] = self.used = self.count = 1  # the first place has the end id
        self.odd: dict[bytes, int] = {}  # places of pieces whose hash another piece has

    def _ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has, by the library."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _joined_ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces, which the library encodes faster by JOINED. They are joined only where a text would be cut
        as well, at the start of white space; if not every piece ends with an id, each is encoded for itself."""
        if self.bytes_of is None:
            return self._ids(pieces)
        raw = b"".join(pieces)
        data = np.frombuffer(raw, np.uint8)
        end = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        begin = np.append(0, end[:-1])
        alone = np.zeros(len(pieces), bool)  # white space that isn't ASCII's, strings of added tokens, also over an end
        alone[np.searchsorted(end, _wide_space(data), "right")] = True
        for m in self.added.finditer(raw) if self.added else ():
            a, b = np.searchsorted(end, [m.start(), max(m.start(), m.end() - 1)], "right").tolist()
            alone[a : b + 1] = True
        single = np.ones(len(pieces), bool)
        single[1:] = ~SPACE[data[begin[1:]]] | SPACE[data[begin[1:] - 1]] | alone[1:] | alone[:-1]
        single[::JOINED] = True
        cuts = begin[single].tolist()
        ids, _ = self._ids([raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)], strict=True)])
        ends = np.cumsum(self.bytes_of[ids], dtype=np.int64)
        last = np.searchsorted(ends, end)
        if not len(ids) or ends[-1] != len(raw) or (ends[last] != end).any():
            return self._ids(pieces)
        return ids, np.diff(last, prepend=-1)

    def _add(self, pieces: list[bytes]) -> int:
        """Encode new pieces; returns the first one's place."""
        first = self.count
        for i in range(0, len(pieces), 20_000):
            some = pieces[i : i + 20_000]
            ids, sizes = self._joined_ids(some)
            total, n = len(ids), self.count
            if self.used + total > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat) // 2, total), np.uint32)])
            if n + len(some) > len(self.begin):
                more = max(len(self.begin) // 2, len(some))
                self.hash, self.begin, self.size, self.text_at, self.text_to = (np.concatenate([x, np.zeros(more, x.dtype)]) for x in (self.hash, self.begin, self.size, self.text_at, self.text_to))
            raw = np.frombuffer(b"".join(some), np.uint8)
            chars = np.fromiter(map(len, some), np.int64, len(some))
            held = int(self.text_to[n - 1])
            if held + len(raw) + 8 > len(self.text):
                self.text = np.concatenate([self.text, np.zeros(max(len(self.text) // 2, len(raw) + 8), np.uint8)])
            self.text[held : held + len(raw)] = raw
            self.text_to[n : n + len(some)] = held + np.cumsum(chars)
            self.text_at[n : n + len(some)] = held + np.cumsum(chars) - chars
            self.flat[self.used : self.used + total] = ids
            self.begin[n : n + len(some)] = self.used + np.cumsum(sizes) - sizes
            self.size[n : n + len(some)] = sizes
            self.used += total
            self.count += len(some)
        return first

    def _enter(self, slot: np.ndarray) -> None:
        """Put pieces, whose hashes are new and differ, into the table."""
        if 4 * self.count > 3 * len(self.table):
            kept = self.table[self.table >= 0]
            self.table = np.full(1 << (2 * self.count - 1).bit_length(), -1, np.int32)
            slot = np.concatenate([kept, slot])
        last = np.uint64(len(self.table) - 1)
        at = (self.hash[slot] & last).astype(np.int64)
        while len(slot):
            free = self.table[at] < 0
            self.table[at[free]] = slot[free]
            out = self.table[at] != slot  # taken before, or now by another one
            slot, at = slot[out], (at[out] + 1) & int(last)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the pieces with these hashes, -1 where there is none."""
        last = len(self.table) - 1
        at = (hashes & np.uint64(last)).astype(np.int64)
        slot = self.table[at]
        todo = np.flatnonzero((slot >= 0) & (self.hash[slot] != hashes))
        while len(todo):
            at[todo] = (at[todo] + 1) & last
            found = slot[todo] = self.table[at[todo]]
            todo = todo[(found >= 0) & (self.hash[found] != hashes[todo])]
        return slot

    def _other(self, own: np.ndarray, start: np.ndarray, size: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Which pieces aren't, byte by byte, those in their places of the store."""
        begin, held = self.text_at[slot], windows(self.text)
        bad = size != self.text_to[slot] - begin
        bad |= at_eight(own, start, size) != at_eight(held, begin, size)
        todo, at = np.flatnonzero(~bad & (size > 8)), 8
        while len(todo):
            left = size[todo] - at
            wrong = at_eight(own, start[todo] + at, left) != at_eight(held, begin[todo] + at, left)
            bad[todo[wrong]] = True
            at += 8
            todo = todo[~wrong & (left > 8)]
        return np.flatnonzero(bad)

    def encode(self, texts: pa.Array | list, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by ``end``, and the texts' offsets in them. Null is empty."""
        if self.count > MOST_PIECES or self.used > MOST_IDS or self.text_to[self.count - 1] > MOST_BYTES:
            self.clear()
        self.flat[0] = end
        data, off = buffer(texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.large_string()))
        n = len(data)
        raw = data.tobytes()
        kind = np.frombuffer(raw.translate(_KINDS), np.uint8)
        cut = np.zeros(n, bool)
        cut[1:] = (kind[1:] & ~kind[:-1] & 1) | ((kind[1:] << 1) & kind[:-1] & 4)
        whole = _wide_space(data)
        if self.added:
            whole = np.concatenate([whole, np.array([m.start() for m in self.added.finditer(raw)], np.int64)])
        for d in np.unique(np.searchsorted(off, whole, "right") - 1):
            cut[off[d] : off[d + 1]] = False
        cut[off[off < n]] = True
        start = np.flatnonzero(cut)
        stop = np.append(start[1:], n) if len(start) else start
        hashes = span_hashes(data, start, stop)
        slot = self._find(hashes)
        new = np.flatnonzero(slot < 0)
        if len(new):
            kinds, one, of = np.unique(hashes[new], return_index=True, return_inverse=True)
            which = new[one]
            first = self._add([raw[a:b] for a, b in zip(start[which].tolist(), stop[which].tolist(), strict=True)])
            self.hash[first : first + len(which)] = kinds
            self._enter(np.arange(first, first + len(which), dtype=np.int32))
            slot[new] = first + of
        if len(slot):
            for i in self._other(eights(data), start, stop - start, slot).tolist():
                piece = raw[start[i] : stop[i]]
                if piece not in self.odd:
                    self.odd[piece] = self._add([piece])
                slot[i] = self.odd[piece]
        bound = np.searchsorted(start, off)
        slot = np.insert(slot, bound[1:], 0)  # each text's end
        size = self.size[slot]
        ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        out = self.flat[np.repeat(self.begin[slot] - ends[:-1], size) + np.arange(ends[-1])]
        return out, ends[bound + np.arange(len(bound))]
