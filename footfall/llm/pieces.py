"""Pieces of byte-level BPE: all texts of a slice are cut at once, and each different piece is encoded once."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: The pattern that ``Cutter`` follows.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of the longest piece that is remembered.
LONGEST = 64

UNKNOWN, SPACE, LETTER, NUMBER, OTHER, EDGE = range(6)
#: Stands after each text; no byte of UTF-8.
END = b"\xff"


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring rows of no more than ``most`` in all, or one row."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(ends):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right"))
        yield lo, max(hi, lo + 1)
        lo = max(hi, lo + 1)


def blobs(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """One binary value of little-endian 32-bit numbers for each run of ``sizes`` ids."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]) * 4
    if offsets[-1] >= 1 << 31:
        raise ValueError("too many ids in one slice")
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids.astype("<u4", copy=False))]
    return pa.Array.from_buffers(pa.binary(), len(sizes), buffers)


class Cutter:
    """Cuts texts as ``BYTE_LEVEL`` does, by the kinds of neighbouring characters.

    ``split`` cuts one text; it is asked once about each character, whose kind follows from what it stays with.
    """

    def __init__(self, split: Callable[[str], list]) -> None:
        self.split = split
        self.kind = np.zeros(0x110000, np.uint8)
        self.of_byte = np.zeros(256, np.uint8)
        self.of_byte[:128] = self.kind[:128] = [self._kind(chr(c)) for c in range(128)]
        self.of_byte[END[0]] = EDGE

    def _kind(self, char: str) -> int:
        for before, kind in (("a", LETTER), ("1", NUMBER), ("-", OTHER)):
            if len(self.split(before + char)) == 1:
                return kind
        return SPACE

    def _kinds(self, data: np.ndarray) -> np.ndarray:
        """Kind of the character each byte belongs to."""
        kinds = self.of_byte[data]
        lead = np.flatnonzero((data >= 0xC0) & (data < END[0]))
        if not len(lead):
            return kinds
        char = data[lead].astype(np.int32)
        more = 1 + (char >= 0xE0) + (char >= 0xF0)
        char &= 0x3F >> more
        rest = [(i, more >= i) for i in (1, 2, 3)]
        for i, has in rest:
            char[has] = char[has] << 6 | data[lead[has] + i] & 0x3F
        found = self.kind[char]
        if not found.all():
            for c in np.unique(char[found == UNKNOWN]).tolist():
                self.kind[c] = self._kind(chr(c))
            found = self.kind[char]
        kinds[lead] = found
        for i, has in rest:
            kinds[lead[has] + i] = found[has]
        return kinds

    def starts(self, data: np.ndarray) -> np.ndarray:
        """Where the pieces begin in the UTF-8 of texts, ``END`` after each; each ``END`` is a piece."""
        kinds = self._kinds(data)
        begins = np.ones(len(data), bool)
        np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
        begins[kinds == EDGE] = True
        # The last of several white spaces stands alone before something visible, or goes with it if it is a space.
        last = np.flatnonzero(begins[1:] & (kinds[:-1] == SPACE) & (kinds[1:] != EDGE))
        at = last.copy()
        while (inner := data[at] & 0xC0 == 0x80).any():
            at[inner] -= 1
        begins[at] = True
        begins[last[data[last] == 0x20] + 1] = False
        short = np.flatnonzero(data == 0x27)
        short = short[begins[short]]
        short = short[kinds[short + 1] == LETTER]
        one, two = data[short + 1], data[short + 2]
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        begins[short[pair | single] + 1] = False
        begins[short[single] + 2] = True
        begins[short[pair] + 3] = True
        return np.flatnonzero(begins)

    def __call__(self, texts: list[str]) -> pa.Array:
        data = END.join([*(t.encode("utf-8") for t in texts), b""])
        starts = self.starts(np.frombuffer(data, np.uint8))
        offsets = np.append(starts, len(data)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def by_pattern(find: Callable[[str], list[str]]) -> Callable[[list[str]], pa.Array]:
    """The same for any pattern, one text after the other."""

    def cut(texts: list[str]) -> pa.Array:
        return pa.array([p for t in texts for p in (*(x.encode("utf-8") for x in find(t)), END)], pa.binary())

    return cut


class Memory:
    """Encodes texts by the ids of their pieces; of pieces met before the ids are at hand.

    ``cut`` gives the pieces of texts, ``END`` after each text; ``encode`` the ids of one piece. Beyond ``most``
    pieces the rare ones are forgotten, which changes speed only.
    """

    def __init__(self, cut: Callable[[list[str]], pa.Array], encode: Callable[[bytes], list[int]], most: int) -> None:
        self.cut, self.fresh, self.most = cut, encode, most
        self.at: dict[bytes, int] = {}
        self.ids, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int32)
        #: Slices a piece was met in.
        self.met = np.zeros(0, np.int32)

    def _learn(self, pieces: list[bytes], end: list[int]) -> None:
        """Put the ids of new pieces, and last those of ``END``, behind the others."""
        found, sizes, fresh = array("I"), array("i"), self.fresh
        for piece in pieces:
            ids = fresh(piece)
            found.extend(ids)
            sizes.append(len(ids))
        found.extend(end)
        sizes.append(len(end))
        size = np.frombuffer(sizes, np.int32)
        self.begin = np.concatenate([self.begin, (len(self.ids) + np.cumsum(size) - size).astype(np.int32)])
        self.ids = np.concatenate([self.ids, np.frombuffer(found, np.uint32)])
        self.size = np.concatenate([self.size, size])
        self.met = np.concatenate([self.met, np.zeros(len(size), np.int32)])

    def _keep(self, n: int) -> None:
        """Only the first ``n`` pieces stay."""
        if n < len(self.begin):
            self.ids = self.ids[: self.begin[n]].copy()
        self.begin, self.size, self.met = self.begin[:n].copy(), self.size[:n].copy(), self.met[:n].copy()

    def _spread(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of these numbers in a row, and where each piece's end."""
        size = self.size[at]
        ends = np.cumsum(size, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total)
        place += np.repeat(self.begin[at] - ends + size, size)
        return self.ids[place], ends

    def _forget(self) -> None:
        """Pieces met more than once stay, at most half as many as the bound allows."""
        keep = np.flatnonzero(self.met > 1)
        if len(keep) > self.most // 2:
            keep = np.sort(keep[np.argsort(-self.met[keep], kind="stable")[: self.most // 2]])
        names = list(self.at)
        self.at = {names[i]: n for n, i in enumerate(keep.tolist())}
        self.ids, ends = self._spread(keep)
        self.size, self.met = self.size[keep], self.met[keep] >> 1
        self.begin = (ends - self.size).astype(np.int32)

    def encode(self, texts: list[str], end: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, ``end`` after each, and how many are each text's."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        coded = self.cut(texts).dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known, n = self.at, len(self.at)
        at = np.array([known.get(p, -1) for p in pieces], np.int64)
        new = [i for i in np.flatnonzero(at < 0).tolist() if pieces[i] != END]
        short = [i for i in new if len(pieces[i]) <= LONGEST]
        new = short + [i for i in new if len(pieces[i]) > LONGEST]
        edge = pieces.index(END)
        self._learn([pieces[i] for i in new], end)
        at[new] = np.arange(n, n + len(new))
        at[edge] = n + len(new)
        self.met[at] += 1
        index = coded.indices.to_numpy()
        ids, ends = self._spread(at[index])
        known.update(zip([pieces[i] for i in short], range(n, n + len(short))))
        self._keep(len(known))
        if len(known) > self.most:
            self._forget()
        return ids, np.diff(ends[index == edge], prepend=0)
