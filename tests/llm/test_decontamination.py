"""Benchmark search against a plain scoring of every window, whatever the blocks; empty, null, long and repeated rows."""

import math
import random
from collections import Counter

import pytest

from areastats.llm import decontamination as d

DRAW = random.Random(11)
WORDS = [f"w{i}" for i in range(60)]
ITEMS = [(i, " ".join(DRAW.choices(WORDS, weights=range(1, 61), k=DRAW.randrange(8, 25)))) for i in range(40)]
ITEMS += [(40, ITEMS[3][1]), (41, "five words are quite short"), (42, None), (43, ""), (44, "... !!"), (None, "no id but words")]
SEEN = " ".join(DRAW.choices(WORDS, k=300))


def texts():
    rows = [(1, None), (2, ""), (3, "  "), (4, ITEMS[3][1]), (5, f"{SEEN} {ITEMS[7][1]} {SEEN}"), (6, SEEN), (6, SEEN)]
    rows += [(7, f"“{ITEMS[9][1].upper()}”, and more."), (8, "Five words are quite short!"), (9, "no id but words")]
    rows += [(10, " ".join([SEEN] * 60 + [ITEMS[12][1]])), (None, ITEMS[5][1]), (11, ITEMS[11][1][: len(ITEMS[11][1]) // 2])]
    return rows + [(20 + i, " ".join(DRAW.choices(WORDS, k=DRAW.randrange(5, 120)))) for i in range(60)]


ROWS = texts()


def plain(rows, items, threshold=0.6, similarity=0.8, k1=1.2, b=0.75):
    """Every item against every window, each score in full."""
    cut = [(i, d.tokens(t)) for i, t in items if i is not None and d.tokens(t)]
    n, step = len(cut), max(len(w) for _, w in cut)
    mean, df = sum(len(w) for _, w in cut) / n, Counter(t for _, w in cut for t in set(w))
    idf = {t: math.log(1 + (n - c + 0.5) / (c + 0.5)) for t, c in df.items()}
    out = {}
    for r, (doc, text) in enumerate(rows):
        words = (text or "").lower().split()
        for at in range(0, max(1, len(words)), step):
            passage = d.tokens(" ".join(words[at : at + 2 * step]))
            for item, own in cut:
                tf = Counter(own)
                weight = {t: idf[t] * c * (k1 + 1) / (c + k1 * (1 - b + b * len(own) / mean)) for t, c in tf.items()}
                score = sum(weight[t] for t in weight if t in set(passage)) / sum(weight.values())
                if score < threshold - 1e-9:
                    continue
                half = len(own) - max(5, len(own) // 3)
                parts = (own[:half], own[half:]) if half >= 5 else (own, own)
                if all(shared(part, passage) >= similarity for part in parts):
                    out[r, item] = max(out.get((r, item), 0), score)
    return sorted(((rows[r][0], i, round(x, 9)) for (r, i), x in out.items()), key=str)


def shared(part, passage):
    width = min(5, len(part))
    grams = lambda w: {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
    return len(grams(part) & grams(passage)) / len(grams(part))


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, 1.0, "s") for i, t in ROWS], "doc_id long, text string, score double, item_id string")
    return docs, spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("items_per_block", [20_000, 7])
def test_leaks_equal_plain_scoring_in_any_blocks(tables, items_per_block):
    found = d.leaks(*tables, items_per_block=items_per_block).collect()
    want = plain(ROWS, ITEMS)
    assert sorted(((r.doc_id, r.item_id, round(r.score, 9)) for r in found), key=str) == want
    assert {(4, 3), (4, 40), (5, 7), (7, 9), (8, 41), (10, 12), (None, 5)} <= {(x, y) for x, y, _ in want}


@pytest.mark.parametrize("items_per_block", [20_000, 7])
def test_clean_documents_keep_what_holds_no_item(tables, items_per_block):
    docs, benchmark = tables
    kept = d.clean_documents(docs, benchmark, items_per_block=items_per_block)
    bad = {i for i, _, _ in plain(ROWS, ITEMS)}
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted((i, t or "") for i, t in ROWS if i not in bad)


def test_empty_tables(tables):
    docs, benchmark = tables
    assert d.leaks(docs.limit(0), benchmark).count() == 0 and d.leaks(docs, benchmark.limit(0)).count() == 0
    assert d.clean_documents(docs, benchmark.limit(0)).count() == len(ROWS)
    assert d.leaks(docs, benchmark.where("item_id in (42, 43, 44)")).count() == 0
