"""LM scoring, sharding, mixing, BPE and token files against plain Python and the public libraries."""

import base64
import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from footfall.llm import bpe, ctw, huffman, mixing, queries, sharding
from footfall.session import scratch_path

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def tokens(text):
    return WORD.findall((text or "").encode().lower())


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def weighted(docs, depth):
    """Context-tree weighting by its definition, one position after the other."""
    seen = defaultdict(lambda: [0, 0])

    def steps(text):
        words = tokens(text)
        s = b"\n" * depth + (b" ".join(words) + b" \n" if words else b"\n")
        for at in range(depth, len(s)):
            for j in range(8):
                yield s[at - depth : at], 1 << j | s[at] >> (8 - j), s[at] >> (7 - j) & 1

    for doc_id, text in docs:
        if not held(doc_id):
            for context, place, bit in steps(text):
                for d in range(depth + 1):
                    seen[context[depth - d :], place][bit] += 1
    children = defaultdict(list)
    for context, place in list(seen):
        if context:
            children[context[1:], place].append((context, place))
    known = {}

    def kt(node):
        a, b = seen.get(node, (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def worth(node):
        if node not in known:
            if len(node[0]) == depth:
                known[node] = kt(node)
            else:
                known[node] = np.logaddexp(kt(node), sum(worth(c) for c in children.get(node, ()))) - math.log(2)
        return known[node]

    found = []
    for _, text in docs:
        total = 0.0
        for context, place, bit in steps(text):
            p, left = 0.0, 1.0
            for d in range(depth + 1):
                node = context[depth - d :], place
                a, b = seen.get(node, (0, 0))
                share = math.exp(kt(node) - worth(node) - math.log(2)) if d < depth else 1.0
                p += left * share * (b + 0.5) / (a + b + 1)
                left *= 1 - share
            total += math.log10(p if bit else 1 - p)
        found.append(total)
    return found


def test_ctw_deals_grams_and_stores_counts(spark, monkeypatch):
    """Grams are split into nodes behind the shuffle, not before, and what follows from counts is not stored."""
    stored, tables = ctw.stored, []

    def kept(df, name):
        if name == "ctw":
            tables.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(ctw, "stored", kept)
    grams = spark.createDataFrame([(97 << 8 | 98, 3), (97 << 8 | 99, 1), (98 << 8 | 97, 0)], "key long, n long")
    out = ctw.train(grams, 1)
    lines = tables[0][1].split("\n")
    where = [i for i, line in enumerate(lines) if "Generate" in line]
    assert where and not any("Exchange" in line for line in lines[: where[0]])
    assert tables[0][0] == ["node", "zeros", "ones"] and "kt" not in tables[1][0]
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    lp = {r["key"]: r["lp"] for r in out.collect()}
    assert lp[97 << 8 | 98] > lp[97 << 8 | 99] and len(lp) == 3


def test_ctw_is_the_weighted_mixture(spark):
    docs = [(i, f"The cat sat on mat {i % 3} and the dog ran {'far ' * (i % 4)}") for i in range(30)] + [(99, None), (100, "unseen words ÄÖ")]
    out = {r["doc_id"]: r for r in ctw.score(spark.createDataFrame(docs, "doc_id long, text string"), depth=2).collect()}
    for (doc_id, _), want in zip(docs, weighted(docs, 2)):
        assert out[doc_id]["score"] == pytest.approx(want, abs=1e-7)


def test_lm_scoring_base_and_counts(spark, docs, texts):
    out = {r["doc_id"]: r for r in queries.op1_lm_scoring(spark, "/root/testdata/sf0.001").collect()}
    assert out.keys() == texts.keys()
    c = Counter(w for i, t in texts.items() if not held(i) for w in [*tokens(t), b"\n"])
    n = sum(c.values())
    for i, t in texts.items():
        mine = [*tokens(t), b"\n"]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (len(c) + 1))) for w in mine)
        r = out[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(mine), sum(c[w] > 0 for w in mine), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0


def test_model_beats_words_alone(spark):
    """On 1,000 documents and more; 200 are too few for contexts of five bytes."""
    away = queries.op1_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out")
    assert away.agg(F.sum("score") > F.sum("base_score")).first()[0]


def test_lm_scoring_edges(edge, nothing):
    out = ctw.score(edge).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["n_tokens"]) for r in out if r["doc_id"] in (10, 11, 12)) == [
        (True, 10, 1), (True, 10, 1), (True, 11, 1), (True, 12, 1)
    ]
    assert len(out) == edge.count() and all(math.isfinite(r["score"]) for r in out)
    assert ctw.score(nothing).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 24, 1000, 4097])
def test_permutation(n):
    there = sharding.permute(np.arange(n), n, 7)
    assert sorted(there) == list(range(n))
    assert (sharding.row_at(there, n, 7) == np.arange(n)).all()


def test_shards(edge, nothing, docs, texts):
    for rows in (docs, edge):
        out = sharding.shard_rows(rows, 24).collect()
        sizes = Counter(r["shard"] for r in out)
        counts = [sizes.get(s, 0) for s in range(24)]
        assert len(out) == rows.count() and max(counts) - min(counts) <= 1
        assert sorted((r["shard"], r["slot"]) for r in out) == [(s, k) for s in range(24) for k in range(counts[s])]
    out = sharding.shard_rows(docs, 24).collect()
    for r in out:
        body = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(body) + 8, zlib.crc32(body), "rows")
    again = sharding.shard_rows(docs.repartition(7), 24).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in out} == {r["doc_id"]: (r["shard"], r["slot"]) for r in again}
    assert sharding.shard_rows(nothing, 24).count() == 0


def shares(sizes, weights, budget, cap):
    """Targets by cutting one round after the other."""
    left, open_, target = budget * sum(sizes.values()), set(sizes), {}
    while True:
        whole = sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * left / whole > cap * sizes[s]} if open_ else set()
        if not over:
            return target | {s: weights[s] * left / whole for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over


def test_mix(docs, edge, nothing):
    for rows in (docs, edge):
        got = [(r["doc_id"], r["source"], len(tokens(r["text"]))) for r in rows.select("doc_id", "source", "text").collect()]
        sizes = Counter()
        for _, s, n in got:
            sizes[s] += n
        order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
        want = shares(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
        out = mixing.mix(rows, [3, 1, 2]).collect()
        assert len(out) == len(got)
        taken, longest = Counter(), Counter()
        for r in out:
            assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
            assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
            taken[r["source"]] += r["taken"]
            longest[r["source"]] = max(longest[r["source"]], r["size"])
        for s in sizes:
            assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6
        again = mixing.mix(rows.repartition(5), [3, 1, 2]).collect()
        key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
        assert sorted(map(key, out)) == sorted(map(key, again))
    # Copies that the mix takes are rows of the mix.
    assert mixing.mixed(docs, [3, 1, 2]).count() == mixing.mix(docs, [3, 1, 2]).agg(F.sum("copies")).first()[0]
    assert mixing.mixed(edge, [3, 1, 2]).columns == edge.columns
    assert mixing.mix(nothing, [3, 1, 2]).count() == 0 and mixing.mixed(nothing, [3, 1, 2]).count() == 0


def test_bpe_agrees_with_the_library(docs, edge, nothing):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for rows in (docs, edge):
        want = sorted(
            (str(d), len(ids := own.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
            for d, t in rows.select("doc_id", "text").collect()
        )
        out = bpe.round_trip(rows, RANKS, public_tokenizers.PATTERN).collect()
        assert sorted((str(r[0]), r[1], r[2], r[3]) for r in out) == want
        assert all(r["bad_chars"] == 0 for r in out)
    assert bpe.round_trip(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_utf8_machine_in_any_pieces():
    data = "aß漢\U0001f600�z".encode() + b"\xff\xe6\xbc"
    for step in range(1, len(data) + 1):
        machine = bpe.Utf8Decoder()
        text = "".join(machine.feed(data[i : i + step]) for i in range(0, len(data), step)) + machine.feed(b"", last=True)
        assert text == data.decode("utf-8", "replace")
        assert machine.wrong == 2


@pytest.mark.parametrize("seed", range(4))
def test_huffman_codes(seed):
    rng = np.random.default_rng(seed)
    counts = (rng.pareto(0.3, 3000) * 3).clip(0, 1e12).astype(np.int64)
    counts[5] = 1
    lengths = huffman.code_lengths(counts, 18)
    used = lengths > 0
    assert (used == (counts > 0)).all() and lengths.max() <= 18
    assert sum(2.0 ** -int(n) for n in lengths[used]) <= 1
    ids = rng.choice(np.flatnonzero(used), 5000).astype(np.uint32)
    bits, marks = huffman.pack(ids, huffman.canonical(lengths), lengths)
    back = huffman.unpack([(bits, marks, len(ids)), (bits, marks, len(ids))], *huffman.table(lengths))
    assert (back[0] == ids).all() and (back[1] == ids).all()


def test_token_files(spark, docs, edge, nothing):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(TOKENIZER)
    lib.encode_special_tokens = True
    for rows in (docs, edge):
        path = scratch_path(spark, "files")
        huffman.write_ids(rows, path, TOKENIZER, 2)
        out = sorted(map(tuple, huffman.digest(huffman.read_ids(spark, path)).collect()), key=lambda r: r[1])
        got = rows.select("doc_id", "text").collect()
        want = Counter()
        for d, t in got:
            ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
            want[d, len(ids), zlib.crc32(ids.tobytes())] += 1
        assert Counter((d, n, crc) for d, _, n, crc in out) == want
        assert [r[1] for r in out] == np.cumsum([0, *(r[2] for r in out[:-1])]).tolist()
        ids = [r[0] for r in out]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))
    path = scratch_path(spark, "files")
    huffman.write_ids(nothing, path, TOKENIZER, 2)
    assert huffman.read_ids(spark, path).count() == 0


def test_long_matches_and_odd_chunks():
    """Matches longer than the lookahead, and chunks that hold white space, against the public libraries."""
    own = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.fst.ranks, special_tokens={})
    long = ["ab" * 3000, "é" * 700, "Zq" * 999, "straße" * 400, "=" * 5000, " " * 900 + "x", "x" + "\n" * 600, "日本" * 500]
    odd = ["", " ", "a b  c\n d", "x y z 's don't 'll  ", "\x1c a b\x1c c", "<|endoftext|> a <|endoftext|>b", "c\u0085 d   e", "Ġ Ġa bĠ Ġ"]
    for text in long + odd:
        assert own.encode(text) == lib.encode_ordinary(text)
    files = huffman.Encoder(TOKENIZER)
    want = [e.ids for e in files.lib.encode_batch(long + odd, add_special_tokens=False)]
    for _ in range(2):
        assert [x[:-1].tolist() for x in files.encode(long + odd, 2)] == want


def test_mix_of_unequal_odds(docs, edge):
    """Tilted copies meet the targets: by their expectation, and in each sample to within half a document."""
    tilt = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    for rows in (docs, edge):
        seen = Counter()
        for seed in range(3):
            out = mixing.mix(rows, [3, 1, 2], seed=seed, tilt=tilt).collect()
            by = defaultdict(list)
            for r in out:
                by[r["source"]].append(r)
            for some in by.values():
                assert all(0 <= r["copies"] <= 2 for r in some)
                assert abs(sum(r["taken"] for r in some) - some[0]["target"]) <= max(r["size"] for r in some) / 2 + 1e-6
                odds = lambda level, r: min(2.0, level * (4.0 if (r["doc_id"] or 1) % 2 == 0 else 1.0))
                lo, hi = 0.0, 4.0
                for _ in range(60):
                    mid = (lo + hi) / 2
                    lo, hi = (mid, hi) if sum(odds(mid, r) * r["size"] for r in some) < some[0]["target"] else (lo, mid)
                for r in some:
                    if r["size"]:
                        assert math.floor(odds(hi, r) - 1e-9) <= r["copies"] <= math.ceil(odds(hi, r) + 1e-9)
                        if some[0]["target"] < 1.99 * some[0]["source_size"]:
                            seen[(r["doc_id"] or 1) % 2, "copies"] += r["copies"]
                            seen[(r["doc_id"] or 1) % 2, "hoped"] += odds(hi, r)
        if rows is docs:
            assert all(seen[i, "copies"] == pytest.approx(seen[i, "hoped"], rel=0.15) for i in (0, 1))
    out = mixing.mix(docs, [3, 1, 2], tilt=mixing.by_length()).collect()
    got, want = Counter(), {}
    for r in out:
        got[r["source"]] += r["taken"]
        want[r["source"]] = r["target"]
    assert all(abs(got[s] - want[s]) <= max(r["size"] for r in out if r["source"] == s) / 2 + 1e-6 for s in want)


def test_lookup_takes_little_room_beside_its_keys():
    """Keys and values are not copied into slots; crowded slots and equal slots are still told apart."""
    rng = np.random.default_rng(7)
    for n in (0, 1, 3, 1000, 300_000):
        key = rng.permutation(np.unique(np.concatenate([rng.integers(-(1 << 63), 1 << 63, n), np.arange(n) << 50, [0] * (n > 0)])))
        value = rng.random(len(key))
        told = ctw.Lookup(key, value)
        some = rng.integers(0, max(1, len(key)), 1000 if len(key) else 0)
        assert (told(key[some]) == value[some]).all() and (told(key) == value).all()
        own = sum(a.nbytes for a in vars(told).values() if isinstance(a, np.ndarray) and a is not key and a is not value)
        assert own <= max(64, 16 * len(key))


def test_scratch_tables_go_when_nothing_reads_them(spark, docs, tmp_path):
    """Of a scoring the model is left, not what it was made from; tables outside the scratch folder are left alone."""
    from footfall.llm.common import discard, stored

    kept = str(tmp_path / "kept")
    spark.range(5).write.parquet(kept)
    own = stored(spark.range(5), "own")
    discard(own.unionByName(spark.read.parquet(kept)))
    assert spark.read.parquet(kept).count() == 5
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        own.collect()
    root = scratch_path(spark, "x").rpartition("/")[0].removeprefix("file:")
    before = set(os.listdir(root))
    out = ctw.score(docs)
    assert {name.rpartition("-")[0] for name in set(os.listdir(root)) - before if "-" in name} == {"model"}
    assert out.count() == docs.count()
