"""Byte-level BPE: ids of whole texts, with long unsplit runs joined from halves.

``Bpe`` reads a tokenizer file of the ``tokenizers`` library and gives the same ids.  A long text is cut
where the pattern must end a piece (white space after a non-blank), and each part is encoded alone.  A part
without such a place is encoded by halves: both halves at once, then windows around the join that grow until
the ids at both of their ends are those that the halves have there.  Ids that agree at the ends make every
neighbouring pair a pair of one encoding, which makes the joined ids the encoding of the whole.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import regex
import tiktoken

#: Fixed value: the pattern by which byte-level BPE of this kind splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space of the pattern, which is a little less than Python's.
_SPACE = "[\\t-\\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]"
_BREAK = regex.compile(rf"(?<!{_SPACE})(?={_SPACE})")
_PIECE = regex.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:(?!{_SPACE})[^\p{{L}}\p{{N}}])").replace(r"\s+(?!\S)", rf"{_SPACE}+(?={_SPACE}|\Z)").replace(r"|\s+", rf"|{_SPACE}+"))
#: Characters that are encoded in one go, and ids on either side of a join that the first window holds.
WHOLE, WINDOW = 1 << 14, 16


def _byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    def __init__(self, path: str, whole: int = WHOLE, window: int = WINDOW):
        with open(path, encoding="utf-8") as file:
            kept = json.load(file)
        self.added = {t["content"]: t["id"] for t in kept["added_tokens"]}
        letters = _byte_of_letter()
        ranks = {bytes(map(letters.__getitem__, k)): v for k, v in kept["model"]["vocab"].items() if k not in self.added}
        self._coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = max([*ranks.values(), *self.added.values()]) + 1
        self.bytes_of = [b""] * size
        for k, v in [*ranks.items(), *((k.encode(), v) for k, v in self.added.items())]:
            self.bytes_of[v] = k
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.decimal = [str(i) for i in range(size)]
        self._added = regex.compile("|".join(regex.escape(k) for k in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.whole, self.window = whole, window

    # --- encoding ------------------------------------------------------------

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit numbers; names of added tokens in the text become their ids."""
        if self._added is None or not any(k in text for k in self.added):
            return self._plain(text)
        out, at = [], 0
        for m in self._added.finditer(text):
            out += [self._plain(text[at : m.start()]), np.array([self.added[m[0]]], np.uint32)]
            at = m.end()
        return np.concatenate([*out, self._plain(text[at:])])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def _whole(self, text: str) -> np.ndarray:
        return self._coder.encode_to_numpy(text, disallowed_special=())

    def _plain(self, text: str) -> np.ndarray:
        if len(text) <= self.whole:
            return self._whole(text)
        parts, at = [], 0
        while at < len(text):
            end = len(text)
            if end - at > self.whole and (m := _BREAK.search(text, at + self.whole)):
                end = m.start()
            parts.append(text[at:end])
            at = end
        return np.concatenate([self._tree(p) if len(p) > 2 * self.whole else self._whole(p) for p in parts])

    def _tree(self, text: str) -> np.ndarray:
        """Ids of a text that nothing splits, from those of its smallest halves upwards."""
        count = 1 << max(1, (len(text) // self.whole).bit_length())
        cuts = [len(text) * i // count for i in range(count + 1)]
        level = [(a, b, i) for a, b, i in zip(cuts, cuts[1:], self._coder_batch([text[a:b] for a, b in zip(cuts, cuts[1:])]))]
        while len(level) > 1:
            level = [(a, b, self._join(text, a, m, b, x, y)) for (a, m, x), (_, b, y) in zip(level[::2], level[1::2])]
        return level[0][2]

    def _coder_batch(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.uint32) for x in self._coder.encode_ordinary_batch(texts, num_threads=2)]

    def _join(self, text: str, a: int, m: int, b: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of ``text[a:b]`` from those of ``text[a:m]`` and ``text[m:b]``."""
        whole, ours, theirs = text[a:b], text[a:m], text[m:b]
        back = max((x.start() for x in _BREAK.finditer(whole, 0, len(ours))), default=0)  # a piece is sure to start here
        u, v = _common(whole, ours, back, m - a)
        if _PIECE.match(whole, u).end() == v and _PIECE.match(ours, u).end() == m - a and _PIECE.match(theirs, 0).end() == v - (m - a):
            return self._inside(whole[u:v].encode(), len(whole[u : m - a].encode()), left, right)
        head = left[: self._count(left, len(ours[u:].encode()), True)]
        middle = [self._piece(p.encode()) for p in _pieces(whole, u, v)]
        return np.concatenate([head, *middle, right[self._count(right, len(whole[m - a : v].encode()), False) :]])

    def _piece(self, piece: bytes) -> np.ndarray:
        return np.array(self._coder._encode_single_piece(piece), np.uint32)

    def _count(self, ids: np.ndarray, size: int, from_end: bool) -> int:
        """Where ``size`` bytes at the start or the end of ``ids`` end or begin."""
        if from_end:
            return len(ids) - int(np.searchsorted(np.cumsum(self.lengths[ids[::-1]]), size)) - 1 if size else len(ids)
        return int(np.searchsorted(np.cumsum(self.lengths[ids]), size)) + 1 if size else 0

    def _inside(self, piece: bytes, cut: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Join within one piece: windows of ids around the join, twice as wide each time."""
        ours, theirs = len(left) - self._count(left, cut, True), self._count(right, len(piece) - cut, False)
        k = self.window
        while True:
            p, q = min(k, ours), min(k, theirs)
            x, y = left[len(left) - p :], right[:q]
            low, high = cut - int(self.lengths[x].sum()), cut + int(self.lengths[y].sum())
            ids = self._piece(piece[low:high])
            if (p == ours or ids[0] == x[0]) and (q == theirs or ids[-1] == y[-1]):
                return np.concatenate([left[: len(left) - p], ids, right[q:]])
            k *= 2


def _common(whole: str, ours: str, back: int, m: int) -> tuple[int, int]:
    """Up to where, from ``back`` on, the whole has the first half's pieces, and from where it has the second's."""
    u = back
    while u < m and (end := _PIECE.match(whole, u).end()) == _PIECE.match(ours, u).end():
        u = end
    i, j = u, m
    while i != j:
        if i < j:
            i = _PIECE.match(whole, i).end()
        else:
            j = _PIECE.match(whole, j).end()
    return u, i


def _pieces(text: str, start: int, end: int) -> list[str]:
    out = []
    while start < end:
        stop = _PIECE.match(text, start).end()
        out.append(text[start:stop])
        start = stop
    return out


@functools.lru_cache(maxsize=4)
def loaded(path: str) -> Bpe:
    """One coder per Python worker."""
    return Bpe(path)
