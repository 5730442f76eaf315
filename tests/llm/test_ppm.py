"""Prediction by partial matching against plain Python, and its accuracy on documents that it has not learned from."""

import math
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from areastats.llm import ppm

SF = "/root/testdata/sf0.01"
TEXTS = {
    "aa": ["banana bandana", "an abba ban", "Anna, Ananas!", "", "b"],
    "bb": ["zug um zug", "ünzug über ünz", "zzz zuzu", "umzug zum ünz"],
    "cc": ["banzug"],
}
DEPTH, LEAST = 4, 2


def plain_counts(texts):
    n = defaultdict(int)
    for t in texts:
        b = t.lower().encode()
        for size in range(1, DEPTH + 1):
            for i in range(len(b) - size + 1):
                n[b[i : i + size]] += 1
    return {g: c for g, c in n.items() if c >= LEAST or len(g) == 1}


def plain_p(counts, context, byte):
    """Probability of a byte after a context; a longer context that was never seen falls back to its suffix."""
    if context is None:
        return 1 / 256
    seen = {g[-1]: c for g, c in counts.items() if len(g) == len(context) + 1 and g[:-1] == context}
    shorter = context[1:] if context else None
    if not seen:
        return plain_p(counts, shorter, byte)
    total, kinds = sum(seen.values()), len(seen)
    if byte in seen:
        return seen[byte] / (total + kinds)
    left = 1 - sum(plain_p(counts, shorter, b) for b in seen)
    return kinds / (total + kinds) * plain_p(counts, shorter, byte) / left


def plain_bits(counts, text):
    b = text.lower().encode()
    return sum(math.log2(plain_p(counts, b[max(0, i - DEPTH + 1) : i], b[i])) for i in range(len(b)))


def trees():
    counts = {lang: plain_counts(t) for lang, t in TEXTS.items()}
    rows = [(i, int.from_bytes(b"\1" + g, "big"), c) for i, n in enumerate(counts.values()) for g, c in n.items()]
    lang, gram, n = (np.array(x, np.int64) for x in zip(*rows, strict=True))
    return counts, ppm.Trees.grow(list(TEXTS), lang, gram, n, DEPTH)


@pytest.mark.parametrize("window", [1 << 20, 7, 1])
def test_code_lengths_equal_plain_python(window, monkeypatch):
    monkeypatch.setattr(ppm, "WINDOW", window)
    counts, grown = trees()
    texts = ["", "banana", None, "Anna zug ünz", "", "?qx\x00", "zuzuzuzuzuzu", "ab" * 30, "über bandana über"]
    data, starts = ppm.byte_stream(pa.array(texts))
    got = ppm.Coder(grown).bits(data, starts)
    for row, text in zip(got, texts, strict=True):
        assert row == pytest.approx([plain_bits(n, text or "") for n in counts.values()], rel=1e-4, abs=1e-3)


def test_contexts_sum_to_one():
    counts, _ = trees()
    for n in counts.values():
        for context in (b"", b"a", b"an", b"zu", b"\xc3\xbcn", b"qqq"):
            assert sum(plain_p(n, context, b) for b in range(256)) == pytest.approx(1)


def test_grams_stay_inside_a_text(spark):
    frame = spark.createDataFrame([(k, t) for k, own in TEXTS.items() for t in own], "lang string, text string").coalesce(1)
    got = defaultdict(dict)
    for r in ppm.gram_counts(frame, DEPTH).collect():
        if r.n >= LEAST or r.gram < 1 << 16:
            got[r.lang][int(r.gram).to_bytes(8, "big").lstrip(b"\0")[1:]] = r.n
    assert got == {k: plain_counts(t) for k, t in TEXTS.items()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 1.0) for r in rows], "doc_id long, text string, lang string, score double, held_out double")


def test_edge_cases(spark):
    train = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, "the cat and the dog " * 3, "en") if k % 2 else (i, "der hund und die katze " * 3, "de") for k, i in enumerate(train[:20])]
    long = "the dog and the cat " * 100_000
    rows += [(1000, None, "en"), (1001, "", "de"), (1002, "12 - 34 ...", "en"), (None, "die katze und", "en"), (1003, long, None), (1003, long, None)]
    how = {"max_bytes": 1 << 12}
    got = defaultdict(list)
    for r in ppm.predictions(frame(spark, rows), **how).collect():
        assert 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0)
        got[r.doc_id].append(r.lang_pred)
    assert [got[i] for i in (1000, 1001, 1002, None, 1003)] == [["und"], ["und"], ["und"], ["de"], ["en", "en"]]
    assert all(got[i] == [lang] for i, _, lang in rows[:20])
    unlabelled = ppm.predictions(frame(spark, [(1, "abc", None), (2, None, "en")])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)] * 2
    assert ppm.predictions(frame(spark, [])).count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in ppm.predictions(docs).collect() if r.held_out]
    assert len(held) > 100
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
