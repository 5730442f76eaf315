"""The stages of the corpus pipeline, each against a plain version of what it decides."""

import zlib
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from pyspark.sql import functions as F

from areastats.llm import decontamination, mixing, quality_classifier, simhash

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp int, row string"
A, B, C = (" ".join(f"{w}{i}" for i in range(40)) for w in ("first", "second", "third"))


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "r") for i, t in rows], SCHEMA)


def got(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


def test_one_of_each_with_ids_that_repeat(spark):
    first, second = sorted([A, B], key=lambda t: simhash.signed(simhash.fingerprint(t.encode())))
    cases = [
        ([(1, A), (2, A), (2, B), (3, C)], [(1, A), (2, B), (3, C)]),
        ([(1, A), (1, A), (2, B)], [(1, A), (2, B)]),
        ([(2, B), (2, A)], [(2, B), (2, A)]),
        ([(None, A), (None, A), (None, B), (4, B)], [(None, A), (4, B)]),
        ([(5, None), (6, ""), (7, " \n")], [(5, None)]),
        ([(1, A), (1, B), (0, first)], [(0, first), (1, second)]),
        ([], []),
    ]
    for rows, want in cases:
        kept = simhash.one_of_each(rows_of(spark, rows))
        assert kept.columns == rows_of(spark, []).columns
        assert got(kept) == sorted(want, key=repr)


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64(b" ".join(words[i : i + 3]), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_kept(rows):
    """The smallest id of each component of fingerprints at most two bits apart."""
    prints = {i: plain_print(t) for i, t in rows}
    group = {p: p for p in prints.values()}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for a, b in combinations(set(prints.values()), 2):
        if (a ^ b).bit_count() <= 2:
            group[root(a)] = root(b)
    first = {}
    for i in sorted(prints):
        first.setdefault(root(prints[i]), i)
    return sorted(first.values())


@pytest.fixture(scope="module")
def docs(spark):
    if not Path(SF).exists():
        pytest.skip("driver tables not present")
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_fit_orders_pairs_as_plain_gradient_steps():
    """The fitted weights minimise the logistic loss on feature differences: its gradient vanishes there."""
    rnd = np.random.default_rng(0)
    y = rnd.integers(0, 2, 120)
    x = rnd.random((120, len(quality_classifier.FEATURES))) + y[:, None] * rnd.random(len(quality_classifier.FEATURES)) * 0.5
    model = quality_classifier.fit(x, y, ridge=1e-2)
    z = (x - model.mean) / model.scale
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    n = len(good) * len(bad)
    turn = np.random.default_rng(11).permutation(n)
    diff = z[good[turn % len(good)]] - z[bad[np.arange(n) % len(bad)]]
    wrong = 1 / (1 + np.exp(diff @ model.weights))
    assert np.abs(-(diff * wrong[:, None]).mean(axis=0) + 1e-2 * model.weights).max() < 1e-6
    assert np.mean(z[good] @ model.weights) > np.mean(z[bad] @ model.weights)


def test_quality_of_odd_texts_and_tables(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    good = [(i, f"This is plain sentence number {i}, with words and a stop. It goes on." if i % 2 else "### ||| $$$ 9 9 9") for i in range(40)]
    rows = [*good, (100, None), (101, ""), (102, "word " * 200_000), (None, "### $$$"), (1, good[1][1])]
    out = quality_classifier.classify(rows_of(spark, rows), labels).collect()
    assert len(out) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(r.predicted == r.doc_id % 2 for r in out if r.doc_id is not None and r.doc_id < 40)
    assert quality_classifier.classify(rows_of(spark, []), labels).count() == 0
    assert {r.score for r in quality_classifier.classify(rows_of(spark, good), labels.limit(0)).collect()} == {0.5}


def test_quality_learns_from_every_label(spark):
    """More labels than once were read, and two kinds of pairs: counts, moments, pairs and the cut are those of all rows."""
    rows = spark.range(30_000).selectExpr("id as doc_id", "int(id % 3 = 0) as quality", "transform(sequence(1, 15), i -> pmod(xxhash64(id, i), 1000) / 1000D + if(id % 3 = 0, i / 50D, 0D)) as x")
    pairs = quality_classifier.preference_pairs(rows, 10_000, 20_000, F.col("x"))
    assert pairs.count() == 200_000
    few = rows.where("doc_id < 30")
    assert quality_classifier.preference_pairs(few, 10, 20, F.col("x")).count() == 200
    model = quality_classifier.train_rows(rows)
    x, y = (np.array(v) for v in zip(*((r.x, r.quality) for r in rows.collect()), strict=True))
    assert np.allclose(model.mean, x.mean(axis=0), atol=1e-8) and np.allclose(model.scale, x.std(axis=0), atol=1e-8)
    order = np.sort((x - model.mean) / model.scale @ model.weights)
    near = np.arange(19_000, 21_002)
    best = near[np.argmax(order[near] - order[near - 1])]
    assert model.cut == pytest.approx((order[best] + order[best - 1]) / 2, abs=1e-9)
    again = quality_classifier.train_rows(rows.repartition(7))
    assert (again.weights == model.weights).all() and again.cut == pytest.approx(model.cut, abs=1e-9)


def test_stages(spark, docs):
    """On the small tables: every stage keeps the columns, and its decisions are those of the plain version."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns, frame = docs.columns, docs
    texts = {r.doc_id: r.text for r in docs.collect()}

    one = corpus_pipeline.materialise(corpus_pipeline.quality(spark, frame, SF))
    good = sorted(r.doc_id for r in quality_classifier.classify(frame, labels).collect() if r.predicted)
    assert sorted(r.doc_id for r in one.collect()) == good and one.columns == columns

    two = corpus_pipeline.materialise(corpus_pipeline.near_duplicates(spark, one, SF))
    kept = sorted(r.doc_id for r in two.collect())
    assert kept == plain_kept([(i, texts[i]) for i in good]) and two.columns == columns

    three = corpus_pipeline.materialise(corpus_pipeline.decontaminate(spark, two, SF))
    leaked = {r.doc_id for r in decontamination.leaks(two, spark.read.parquet(f"{SF}/benchmark.parquet")).select("doc_id").collect()}
    clean = [i for i in kept if i not in leaked]
    assert sorted(r.doc_id for r in three.collect()) == clean and three.columns == columns

    four = corpus_pipeline.materialise(corpus_pipeline.mix(spark, three, SF))
    words = {i: len(texts[i].split()) for i in clean}
    taken = {r.doc_id: r.taken for r in mixing.mixed_words(three).collect()}
    copies = Counter(r.doc_id for r in four.collect())
    assert four.columns == columns and all(copies[i] <= 2 for i in clean)
    assert all(copies[i] * words[i] == taken[i] for i in clean if words[i])

    five = corpus_pipeline.shard(spark, four, SF).collect()
    assert Counter(r.doc_id for r in five) == copies
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in five:
        size = len(texts[r.doc_id].encode()) + 16
        assert (r.size, r.text_crc32) == (size, zlib.crc32(texts[r.doc_id].encode()))
        slots[r.shard].append(r.slot)
        sizes[r.shard] += size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))
    largest = max(r.size for r in five) * max(copies.values())
    assert max(sizes.values()) - sum(sizes.values()) / 40 <= largest


def test_mix_comes_near_its_targets(spark):
    """Sources by code point, null last, weigh 5, 2, 1 and so on; what the mix takes is within a document of the target."""
    rows = [(i, "w " * (1 + i % 7), "en", ["b", "a", None, "é"][i % 4], 0, 1, "r") for i in range(400)]
    frame = spark.createDataFrame(rows, SCHEMA)
    total, target, taken = defaultdict(int), {}, defaultdict(int)
    source = {i: r[3] for i, r in enumerate(rows)}
    for r in mixing.mixed_words(frame).collect():
        total[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    share = dict(zip(["a", "b", "é", None], [5, 2, 1, 5], strict=True))
    left, want = 1.5 * sum(total.values()), {}
    open_ = dict(share)
    while True:
        over = [s for s in open_ if left * open_[s] / sum(open_.values()) > 2 * total[s]]
        if not over:
            break
        for s in over:
            want[s] = 2 * total[s]
        left, open_ = 1.5 * sum(total.values()) - sum(want.values()), {s: w for s, w in open_.items() if s not in over}
    want |= {s: left * w / sum(open_.values()) for s, w in open_.items()}
    for s in share:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 7
