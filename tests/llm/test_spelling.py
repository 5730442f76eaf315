"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

from areastats.llm import spelling

SCHEMA = "doc_id long, text string, lang string, n long, word string"


def plain_words(rows, least, often, rate):
    n = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % rate == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= often}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, least=6, often=5, ratio=5, rate=199):
    n = plain_words(rows, least, often, rate)
    near = {w: sorted((v for v in n if one_edit(w, v)), key=lambda v: (-n[v], v)) for w in n}
    form = {w: v[0] for w, v in near.items() if v and n[v[0]] >= ratio * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def got(spark, rows, **how):
    frame = spark.createDataFrame([(d, t, "x", 1, "w") for d, t in rows], SCHEMA)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(frame, **how).collect()}


def texts():
    rnd, rows = random.Random(3), []
    base = ["".join(rnd.choice("aabcé×ÿ") for _ in range(rnd.randint(5, 13))) for _ in range(60)]
    for d in range(120):
        words = []
        for _ in range(60):
            w = rnd.choice(base[: rnd.choice([4, 12, 60])])
            if rnd.random() < 0.5:
                at, c = rnd.randrange(len(w) + 1), rnd.choice("ab")
                w = rnd.choice([w[:at] + c + w[at:], w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :]])
            words.append(w if rnd.random() < 0.8 else w.upper())
        rows.append((d, rnd.choice([" ", "-", ", 7", "\n"]).join(words)))
    return rows


def test_equals_plain_python(spark):
    rows = texts()
    rows += rows[:5]  # repeated rows count again
    rows += [(None, "nullable nullable Nullable NULLABLE nullable nullabel"), (7, None), (8, ""), (9, "12 345 āā")]
    rows.append((10, "longest " * 50_000 + "langest " * 30 + "lanngest " * 5))
    want = plain_variants(rows)
    assert sum(v[0] is not None for v in want.values()) > 20
    assert any(v[0] != v[1] and v[0] for v in want.values())  # a chain
    assert got(spark, rows) == want


def test_lost_letters(spark):
    """With a small rate many runs lose a code point."""
    rows = texts()[:40]
    assert got(spark, rows, rate=3, often=2) == plain_variants(rows, rate=3, often=2)


def test_ties_take_the_first_form(spark):
    rows = [(1, "bananax " * 25 + "bananay " * 25 + "bananaz " * 5)]
    assert got(spark, rows)["bananaz"] == ("bananax", "bananax", 5, 2, 25)


def test_a_hot_word_and_an_empty_table(spark):
    rows = [(i, "hottest " * 500) for i in range(50)] + [(99, "hotest " * 7)]
    assert got(spark, rows) == plain_variants(rows)
    assert got(spark, []) == {}


def test_pairs_equal_brute_force_on_repeating_letters(spark):
    """Words over one or two letters meet at many quarters; each pair comes once in each direction."""
    words = sorted({f"{x:0{size}b}".replace("0", "a").replace("1", "b") for size in (6, 7, 8, 9) for x in range(40)})
    pairs = spelling.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long"))
    assert sorted((r.word, r.other) for r in pairs.collect()) == sorted((a, b) for a in words for b in words if one_edit(a, b))
