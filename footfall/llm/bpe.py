"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by a UTF-8 state machine."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import remembered
from footfall.llm.pieces import BYTE_LEVEL, Cutter, Memory, by_pattern, slices

#: Bounds of what a worker remembers; beyond them it forgets what is old, which changes speed only.
STATES = 50_000
PAIRS = 200_000
PIECES = 300_000
#: Bytes of text that are encoded together, or one text.
SLICE = 1 << 20
#: Bytes of one match after which tokens that are settled are emitted.
LOOKAHEAD = 256
#: Ids that go through the decoder at once.
STEP = 1 << 14


class Transducer:
    """Reads bytes, emits the ids of their BPE encoding.

    A sequence of tokens is the encoding of its bytes exactly if each neighbouring pair is the encoding of
    its own bytes. So the set of encodings is read by an automaton whose states are (last token, place in
    the trie of all tokens). Determinised, a state is the set of readings that are still open. Every prefix
    has one encoding, so there is one reading per place at which an open token may begin, no more than the
    longest token has bytes; and each step puts out one token, the last of the encoding of what was read.
    Going back over these gives the encoding. Tokens that all open readings share are settled; they are emitted
    after at most ``LOOKAHEAD`` bytes and what an open token may reach back over. States and their steps
    are made when a text first needs them.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.next_node: dict[int, int] = {}
        self.token_at = [-1]
        self.leaf = [True]
        self.depth = [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                at = node << 8 | byte
                if at not in self.next_node:
                    self.next_node[at] = len(self.token_at)
                    self.token_at.append(-1)
                    self.leaf.append(True)
                    self.depth.append(self.depth[node] + 1)
                    self.leaf[node] = False
                node = self.next_node[at]
            self.token_at[node] = rank
        self.pairs: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[tuple[int, ...], int] = {}
        self.states: list[tuple[int, ...]] = []
        self.steps: dict[int, int] = {}
        self.start = self._state((0,))

    def _state(self, readings: tuple[int, ...]) -> int:
        """Number of a state; a reading is (last token + 1) << 32 | place in the trie."""
        at = self.ids.get(readings)
        if at is None:
            at = self.ids[readings] = len(self.states)
            self.states.append(readings)
        return at

    def merged(self, data: bytes) -> list[bytes]:
        """Plain merging by rank, for the short strings that decide whether a pair may stand together."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the two tokens encode their own bytes; left -1: whether the right one encodes its own."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            tokens = [self.bytes_of[right]] if left < 0 else [self.bytes_of[left], self.bytes_of[right]]
            joined = b"".join(tokens)
            # Two tokens that make up a third do not stay apart.
            known = self.pairs[key] = (left < 0 or joined not in self.ranks) and self.merged(joined) == tokens
        return known

    def _step(self, state: int, byte: int) -> int:
        """The next state << 32 | the token put out."""
        readings, done = [], -1
        for reading in self.states[state]:
            node = reading & 0xFFFFFFFF
            child = self.next_node.get(node << 8 | byte)
            if child is None:
                continue
            token = self.token_at[child]
            if token >= 0 and done < 0 and self.may_follow((reading >> 32) - 1, token):
                done = token
            if not self.leaf[child]:
                readings.append(reading - node + child)
        if done < 0:
            raise ValueError("the vocabulary lacks a single byte")
        readings.append(done + 1 << 32)
        return self._state(tuple(readings)) << 32 | done

    def _path(self, lasts: list[int], end: int) -> list[int]:
        """Encoding of the first ``end`` bytes, from the last token of each prefix."""
        size, out = self.size, []
        while end > 0:
            token = lasts[end - 1]
            out.append(token)
            end -= size[token]
        out.reverse()
        return out

    def _settled(self, state: int, lasts: list[int]) -> int:
        """The place up to which all open readings share their tokens."""
        places = {len(lasts) - self.depth[r & 0xFFFFFFFF] for r in self.states[state]}
        while len(places) > 1:
            far = max(places)
            places.remove(far)
            places.add(far - self.size[lasts[far - 1]])
        return places.pop()

    def encode(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern; a match that is a token as it stands is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(self.states) > STATES:
            self._forget()
        state, out, lasts, steps = self.start, [], [], self.steps
        for lo in range(0, len(data), LOOKAHEAD):
            if lo:
                cut = self._settled(state, lasts)
                out += self._path(lasts, cut)
                del lasts[:cut]
            for byte in data[lo : lo + LOOKAHEAD]:
                key = state << 8 | byte
                step = steps.get(key)
                if step is None:
                    step = steps[key] = self._step(state, byte)
                state = step >> 32
                lasts.append(step & 0xFFFFFFFF)
        return out + self._path(lasts, len(lasts))


class Utf8Decoder:
    """Bytes come in pieces, characters go out; a character cut by a piece waits for the rest.

    The state is the up to three bytes of an unfinished character. Bytes that cannot belong to a character
    become U+FFFD and are counted in ``wrong``.
    """

    def __init__(self) -> None:
        self.open = b""
        self.wrong = 0

    def feed(self, data: bytes, last: bool = False) -> str:
        data = self.open + data
        cut = len(data)
        if not last:
            for back in range(1, min(3, len(data)) + 1):
                byte = data[-back]
                if byte >= 0xC0:
                    need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                    cut -= back if need > back else 0
                    break
                if byte < 0x80:
                    break
        self.open = data[cut:]
        try:
            return data[:cut].decode("utf-8")
        except UnicodeDecodeError:
            text = data[:cut].decode("utf-8", "replace")
            self.wrong += text.count("�") - data[:cut].count(b"\xef\xbf\xbd")
            return text


class Codec:
    """Encoder and decoder of one vocabulary, with a bounded memory for the pieces the pattern cuts."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fst = Transducer(ranks)
        self.digits = {i: str(i) for i in self.fst.bytes_of}
        find = regex.compile(pattern).findall
        self.memory = Memory(Cutter(find) if pattern == BYTE_LEVEL else by_pattern(find), self.fst.encode, PIECES)

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        ids, sizes = self.memory.encode(texts, [])
        ends = np.cumsum(sizes).tolist()
        return (ids[a:b].tolist() for a, b in zip([0, *ends], ends))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: list[int]) -> Iterator[bytes]:
        token = self.fst.bytes_of.__getitem__
        for lo in range(0, len(ids), STEP):
            yield b"".join(map(token, ids[lo : lo + STEP]))


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process, while it encodes."""
    return remembered((Codec, path, pattern), lambda: Codec(path, pattern))


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and decode its ids again, one row per row.

    Columns: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space), decoded_sha256 (of the
    decoded bytes), n_chars (characters the UTF-8 machine gave out), bad_chars (those it had to replace). A
    null text is encoded as the empty text; repeated rows give repeated rows; other columns are not carried.
    Nothing is shuffled. ``path`` names a rank file that every executor has installed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        digits = own.digits.__getitem__
        for batch in batches:
            found = []
            length = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for lo, hi in slices(length, SLICE):
                for ids in own.encode_all([t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]):
                    whole, machine, chars = hashlib.sha256(), Utf8Decoder(), 0
                    for data in own.decode(ids):
                        whole.update(data)
                        chars += len(machine.feed(data))
                    chars += len(machine.feed(b"", last=True))
                    listed = hashlib.sha256(" ".join(map(digits, ids)).encode()).hexdigest()
                    found.append((len(ids), listed, whole.hexdigest(), chars, machine.wrong))
            cols = list(zip(*found)) if found else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_chars", "bad_chars"],
            )

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    return slim.mapInArrow(
        run,
        f"doc_id {dict(slim.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_chars long, bad_chars long",
    )
