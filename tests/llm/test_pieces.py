"""Pieces of byte-level BPE: cut at once as the pattern and the library cut them, encoded once each."""

import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer, models, pre_tokenizers

from footfall.llm import bpe, huffman, pieces

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "aabzstmdrevlLE'''' '  \n\t\r\x00\x0b\x1c\x85  　 11٣²%%-&éß߀日本🙂́​࢏꟎"


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(40))) for _ in range(n)] + ["", "x", " ", "'s", "a'", "''ll", " 're", " ", "é"]


def test_cut_as_pattern_and_library():
    find = regex.compile(public_tokenizers.PATTERN).findall
    lib = Tokenizer.from_file(TOKENIZER).pre_tokenizer.pre_tokenize_str
    some = texts(5000)
    assert pieces.BYTE_LEVEL == public_tokenizers.PATTERN
    want = [p for t in some for p in (*(x.encode() for x in find(t)), pieces.END)]
    assert pieces.Cutter(find)(some).to_pylist() == want == pieces.by_pattern(find)(some).to_pylist()
    want = [p for t in some for p in (*(t[a:b].encode() for _, (a, b) in lib(t)), pieces.END)]
    assert pieces.Cutter(lib)(some).to_pylist() == want


def test_library_is_asked_once_for_a_piece():
    files, asked = huffman.Encoder(TOKENIZER), []
    fresh = files.memory.fresh
    files.memory.fresh = lambda piece: asked.append(piece) or fresh(piece)
    some = ["a word, a word. A word%%% word!!", "the word, and\nword%%%", "", "word, word%%%"]
    for _ in range(2):
        got = [x.tolist() for x in files.encode(some, 2)]
        assert got == [[*e.ids, 2] for e in files.lib.encode_batch(some, add_special_tokens=False)]
    assert len(asked) == len(set(asked)) and asked.count(b" word") == 1


@pytest.mark.parametrize("pattern", [public_tokenizers.PATTERN, r"\p{L}{1,3}|\s+|[^\p{L}\s]+"])
def test_transducer_reads_a_piece_once(pattern):
    """Also where punctuation sets words apart; another pattern than that of ``Cutter`` is followed too.

    Without the two letters of Unicode 17, which the library's tables lack.
    """
    own, read = bpe.Codec(RANKS, pattern), []
    fresh = own.memory.fresh
    own.memory.fresh = lambda piece: read.append(piece) or fresh(piece)
    lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=own.fst.ranks, special_tokens={})
    old = str.maketrans("", "", "\u088f\ua7ce")
    for text in ["a word, a word. A word%%% word!!\nword\n word", "", *(t.translate(old) for t in texts(300, seed=5))]:
        assert own.encode(text) == lib.encode_ordinary(text)
    assert len(read) == len(set(read))
    some = [t.translate(old) for t in texts(50, seed=6)]
    assert list(own.encode_all(some)) == [lib.encode_ordinary(t) for t in some]


def test_what_is_forgotten_is_encoded_again(monkeypatch):
    monkeypatch.setattr(huffman, "PIECES", 40)
    monkeypatch.setattr(pieces, "LONGEST", 5)
    files, some = huffman.Encoder(TOKENIZER), texts(400, seed=2)
    want = [[*e.ids, 7] for e in files.lib.encode_batch(some, add_special_tokens=False)]
    got = []
    for lo, hi in pieces.slices(np.array([len(t) for t in some]), 100):
        got += [x.tolist() for x in files.encode(some[lo:hi], 7)]
        known = files.memory
        assert len(known.at) == len(known.begin) == len(known.size) == len(known.met) <= 40 and max(map(len, known.at), default=0) <= 5
    assert got == want


def test_other_tokenizers_encode_whole_texts(tmp_path):
    lib = Tokenizer(models.WordLevel({"a": 0, "b": 1, "?": 2}, "?"))
    lib.pre_tokenizer = pre_tokenizers.Whitespace()
    lib.save(str(tmp_path / "words.json"))
    files = huffman.Encoder(str(tmp_path / "words.json"))
    assert [x.tolist() for x in files.encode(["a b a", "", "c b"], 9)] == [[0, 1, 0, 9], [9], [2, 1, 9]]


def test_slices_and_blobs():
    assert list(pieces.slices(np.array([3, 3, 9, 0, 1, 5]), 6)) == [(0, 2), (2, 3), (3, 6)]
    assert list(pieces.slices(np.array([], np.int64), 6)) == []
    out = pieces.blobs(np.arange(5, dtype=np.uint32), np.array([2, 0, 3]))
    assert [np.frombuffer(x, "<u4").tolist() for x in out.to_pylist()] == [[0, 1], [], [2, 3, 4]]


@pytest.mark.parametrize("far", [0, 1 << 28])
def test_blocks_of_unequal_length(far):
    """Lanes that end early, a block of one id, and ids that need more than 27 bits."""
    rng = np.random.default_rng(3)
    lengths = huffman.code_lengths(np.bincount(rng.geometric(0.01, 5000)))
    codes = huffman.canonical(lengths)
    blocks, want = [], []
    for n in (1, 5000, 1024, 3, 1025):
        ids = rng.choice(np.flatnonzero(lengths), n).astype(np.uint32)
        blocks.append((*huffman.pack(ids, codes, lengths), n))
        want.append((ids + np.uint32(far)).tolist())
    symbol, size, width = huffman.table(lengths)
    assert [x.tolist() for x in huffman.unpack(blocks, symbol + np.uint32(far), size, width)] == want
