"""The operators against plain Python on a small table with null, empty, long and repeated texts."""

import math
import zlib
from collections import Counter
from itertools import combinations

import pytest
import regex
import xxhash

from areastats.llm import mixing, ngram_lm, pii, quality_rules, sharding, simhash, token_files, warc

LONG = " ".join(f"word{i} of a long text" for i in range(3_000))
ROWS = [
    (1, "a plain text of a few words, written once", "x"),
    (2, "a plain text of a few words, written once", "x"),
    (3, None, None),
    (4, "", "y"),
    (5, LONG, "y"),
    (6, "mail me at joe.d@example.org or from 10.1.2.3", "x"),
    (7, "One\nTwo\nOne\nThree words", "z"),
    (8, "A PLAIN text of a few words, written once", "z"),
    (9, "card 4111 1111 1111 1111 and phone +49 30 1234567", None),
]
WORD = regex.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", s, len(t or ""), 0) for i, t, s in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, size int")


def lower(text):
    return regex.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_print(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_masks_catch_every_pair_in_radius():
    tables = simhash.masks(2)
    for bits in [(), *((a,) for a in range(64)), *combinations(range(64), 2)]:
        diff = sum(1 << b for b in bits)
        assert any(diff & m & (1 << 64) - 1 == 0 for m in tables)


def test_simhash_equals_all_pairs(docs):
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = {i: plain_print(t) for i, t, _ in ROWS}
    group = {i: i for i in prints}
    for _ in prints:
        for a, b in combinations(prints, 2):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                group[a] = group[b] = min(group[a], group[b])
    assert got == {i: (prints[i], group[i]) for i in prints}


def test_shards_are_whole_gapless_and_near_equal(docs):
    rows = sharding.histogram_sort(docs, shards=3).collect()
    assert sorted(r.doc_id for r in rows) == [i for i, *_ in ROWS]
    for r in rows:
        text = (dict((i, t) for i, t, _ in ROWS)[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(text) + 16, zlib.crc32(text))
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))


def test_mix_keeps_bounds_and_reruns_agree(docs):
    first, again = (sorted(map(tuple, mixing.mixed_words(docs).collect())) for _ in range(2))
    assert first == again
    for r in mixing.mixed_words(docs).collect():
        assert r["size"] == len(WORD.findall(dict((i, t) for i, t, _ in ROWS)[r.doc_id] or ""))
        assert 0 <= r.taken <= 2 * r["size"]


def test_base_score_of_language_model(docs):
    train, texts = Counter(), {i: [*WORD.findall(lower(t)), None] for i, t, _ in ROWS}
    for i, tokens in texts.items():
        if zlib.crc32(str(i).encode()) % 10:
            train.update(tokens)
    n, v = sum(train.values()), len(train)
    for r in ngram_lm.scores(docs).collect():
        tokens = texts[r.doc_id]
        want = sum(math.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(t in train for t in tokens), n)
        assert r.base_score == pytest.approx(want, rel=1e-9)
        assert r.score <= 1e-9


@pytest.mark.parametrize("head", [2, 4, 1 << 16])
def test_pairs_count_whatever_the_head(spark, head):
    """Scores of a bigram model over all words, in plain Python: words outside the head lose no pair and no backoff."""
    texts = {i: f"the cat{i % 3} sat on the mat{i % 4} the end{i % 7}" for i in range(60)} | {60: "", 61: "unseen words the cat1 sat"}
    got = {r.doc_id: r.score for r in ngram_lm.scores(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), head=head).collect()}
    tokens = {i: [*t.split(), None] for i, t in texts.items()}
    train = [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 10]
    one = Counter(w for t in train for w in t)
    two = {k: n for k, n in Counter(p for t in train for p in zip(t, t[1:])).items() if n >= 2}
    left = {a: 1 - sum(n - 0.75 for (x, _), n in two.items() if x == a) / one[a] for a in one}
    unigram = {w: (one[w] + 0.1) / (sum(one.values()) + 0.1 * (len(one) + 1)) for t in tokens.values() for w in t}
    for i, t in tokens.items():
        want = math.log10(unigram[t[0]])
        for a, b in zip(t, t[1:]):
            p = left.get(a, 1.0) * unigram[b] + ((two[a, b] - 0.75) / one[a] if (a, b) in two else 0)
            want += math.log10(p)
        assert got[i] == pytest.approx(want, abs=1e-4)


def test_personal_data_counts(docs):
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.personal_data(docs).collect()}
    assert got == {i: (0, 0, 0, 0) for i, *_ in ROWS} | {6: (1, 1, 0, 0), 9: (0, 0, 1, 1)}


def test_quality_rules(docs):
    got = {r.doc_id: r for r in quality_rules.verdicts(quality_rules.ledger(docs)).collect()}
    assert (got[3].n_words, got[4].n_words, got[7].n_words, got[7].n_dup_lines) == (0, 0, 5, 1)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got.values())
    assert not any(r.kept for r in got.values() if r.base_failed)


def test_archives_round_trip(spark):
    pages = [(1, "u", "p" * 1_200), (2, "u", "p" * 1_200), (3, None, None), (4, "v", "short"), (5, "v", "short")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(frame).collect()}
    assert got == {
        1: (1_200, "revisit", 2), 2: (1_200, "response", None), 3: (0, "response", None),
        4: (5, "response", None), 5: (5, "response", None),
    }


def test_empty_tables(docs):
    none = docs.limit(0)
    assert simhash.near_duplicates(none).count() == 0
    assert sharding.histogram_sort(none, shards=3).count() == 0
    assert mixing.mixed_words(none).count() == 0
    assert pii.personal_data(none).count() == 0


def test_token_files_equal_the_tokenizer(docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, start = Tokenizer.from_file(vocabulary), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.round_trip(docs, vocabulary).collect()}
    for i, text, _ in ROWS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert got[i] == (start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))
        start += len(ids)


def test_shards_decode_once(monkeypatch):
    """Bulk queries of many blocks read a shard's lists once, not again for every block."""
    import numpy as np

    from areastats.llm.elias_fano import EliasFano

    keys = np.array([1 << 16 | 2, 1 << 16 | 7, 5 << 16 | 1], dtype=np.int64)
    trie, decoded, whole = ngram_lm.Trie(ngram_lm.Trie.build(keys, np.log10([0.5, 0.25, 0.125]))), [], EliasFano.all
    monkeypatch.setattr(EliasFano, "all", lambda own: decoded.append(own) or whole(own))
    for _ in range(20):
        assert trie.log_ps(keys) == pytest.approx(np.log10([0.5, 0.25, 0.125]))
        assert np.isnan(trie.log_ps(keys + 1)).all()
    assert len(decoded) == 2


def test_words_of_blocks_equal_plain_python(monkeypatch):
    """White space of every kind, ends and other control characters, over batches and blocks of a few documents."""
    import pyarrow as pa

    monkeypatch.setattr(ngram_lm, "BLOCK_DOCS", 3)
    monkeypatch.setattr(ngram_lm, "BLOCK_BYTES", 40)
    texts = ["", None, " a  B ", "\x0b\x0ca\t\nb\r", "a\x1cb a\x85b a\xa0b İx", " ", "word " * 20, "a"] * 3
    rows = pa.table({"d": range(len(texts)), "h": [False] * len(texts), "t": pa.array(texts, pa.string())})
    got = []
    for ids, _, own in ngram_lm.blocks(iter(rows.to_batches(5))):
        words, code, doc = ngram_lm.tokens_of(own)
        said = words.to_pylist()
        assert len(ids) <= 3 and (ngram_lm.word_hashes(words) == [ngram_lm.xxhash.xxh64_intdigest(w.encode()) for w in said]).all()
        got += [[said[c].encode() for c, d in zip(code, doc) if d == i] for i in range(len(ids))]
    assert got == [(t or "").encode().lower().split() for t in texts]
