"""Filter audit: every order worked through document by document, packed sums, edges."""

import random
import re
from itertools import permutations

import numpy as np
import pytest

from footfall.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, _part string, _mask string, n int, _good int, _sum string, step string"
LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    """Set of failed filters per row."""
    out = []
    for i, text, _ in rows:
        t = text or ""
        words = WORD.findall(t)
        capitals = len(re.findall("[A-Z]", t))
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * capitals > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows),
        }
        out.append({f for f, bad in fails.items() if bad})
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    failed, found = failures(rows), []
    for part in {r[2] or "" for r in rows}:
        own = [(i, f) for (i, _, p), f in zip(rows, failed) if (p or "") == part]
        shapley, lines = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = list(own)
            for step, letter in enumerate(order, 1):
                gone = [i for i, f in left if letter in f]
                earlier = sum(letter in f for _, f in own) - len(gone)
                left = [(i, f) for i, f in left if letter not in f]
                shapley[letter] += len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), earlier, sum(f == {letter} for _, f in own),
                              sum(i in good for i in gone), sum(i in toxic for i in gone), letter))
        found += [(*line[:-1], shapley[line[-1]]) for line in lines]
    return sorted(found, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, t, p, "x", "y", 1, 2, "z", "s") for i, t, p in rows], SCHEMA)


def test_every_order(spark, rows):
    rng = random.Random(3)
    long = " ".join(f"word{i}" for i in range(120))
    texts = [None, "", " \t\n", "A B C", "# a", long, long + " |", "x " * 150, long.upper(), "X* " * 150, "ÄÖ " + long, "a\x0bb\x1cc d " * 40]
    docs = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(150)]
    docs += [(7, long, "en"), (7, long, "en"), (1000, long, None)]
    labels = [(i, rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for i in [None, *range(0, 60, 2), 4, 6, 99]]
    got = rows(audit.audit(table(spark, docs).repartition(5), spark.createDataFrame(labels, LABELS)))
    assert got == brute(docs, labels)


def test_edges(spark, edge, nothing):
    none = spark.createDataFrame([], LABELS)
    out = audit.audit(nothing, none)
    assert out.count() == 0 and out.columns == ["part", "filter_order", "step", *audit.COUNTS, "shapley"]
    assert audit.audit(edge, none).count() == audit.STEPS


@pytest.mark.parametrize("mask", range(32))
def test_fields_never_meet(mask):
    """Counts far beyond any table, added up for all kinds of documents, are read back as they were."""
    n = (1 << 55) // (mask + 1)
    kinds = [(mask, g, t) for g in (False, True) for t in (False, True)]
    total = sum(audit.packed(audit.outcomes(*k)) * n for k in kinds)
    assert (audit.unpacked(total) == sum(audit.outcomes(*k) for k in kinds) * n).all()


def test_parts_beyond_what_a_task_holds(spark):
    docs = [(i, "a", f"p{i % 700}") for i in range(1400)]
    out = audit.audit(table(spark, docs), spark.createDataFrame([], LABELS))
    first = out.where("filter_order = 'ABCDE' and step = 1").collect()
    assert len(first) == 700 and {r["removed"] for r in first} == {2} and out.count() == 700 * audit.STEPS


def test_words_in_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    text = b"".join(bytes(rng.integers(97, 100, rng.integers(1, 6)).tolist()) + rng.choice([b" ", b"\n", b"\t  "]) for _ in range(500))
    for piece in (1, 3, 64, 1 << 20):
        monkeypatch.setattr(audit, "PIECE", piece)
        assert audit._words(text) == (len(text.split()), len(set(text.split())))
