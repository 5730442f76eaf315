"""Alignment of two tokenizers against plain Python with the tokenizers library."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from areastats.llm import token_pairs
from areastats.llm.perfect_hash import PerfectHash
from areastats.llm.token_files import byte_letters

public_tokenizers = pytest.importorskip("public_tokenizers")
ONE, TWO = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(ONE)
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=TWO)


def texts():
    rnd = random.Random(5)
    marks = ["the ", "Größe", " naïve\n", "don't", "\t\t", "  ", "日本語", "🙂", "<|endoftext|>", "<s>", "0x41", " ", "é", "1234567", "###", "　", "\r\n"]
    rows = ["".join(rnd.choice(marks) for _ in range(rnd.randint(1, 30))) for _ in range(60)]
    return [*rows, "", None, " ", "a▁b", "<unk>", "\x00", "x" * 30_000, " ".join(f"word{i}" for i in range(20_000)), rows[0], "\n" * 50_000]


def plain(rows, one, two):
    byte_of = {c: b for b, c in byte_letters().items()}
    out, holding = [], Counter()
    for text in rows:
        got = None
        if text:
            a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
            bytes_a = [bytes(byte_of[c] for c in one.id_to_token(i)) for i in a]
            bytes_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                got = align(a, [len(x) for x in bytes_a], b, [len(x) for x in bytes_b])
                holding.update(set(got[1]))
        out.append(got)
    best = defaultdict(int)
    for (a, _), n in holding.items():
        best[a] = max(best[a], n)
    result = []
    for got in out:
        if got is None:
            result.append((0, 0, 0, 0, 0, 0, ""))
            continue
        groups, links, n_a, n_b = got
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        good = sum(holding[p] == best[p[0]] for p in links)
        result.append((n_a, n_b, len(groups), len(links), good, sum(holding[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return result


def align(a, len_a, b, len_b):
    groups, links, i, j, end_a, end_b = [([], [])], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if end_a == end_b and groups[-1][0]:
            groups.append(([], []))
        if end_a <= end_b:
            groups[-1][0].append(a[i])
            end_a, i = end_a + len_a[i], i + 1
        else:
            groups[-1][1].append(b[j])
            end_b, j = end_b + len_b[j], j + 1
        if end_a == end_b and not groups[-1][1]:
            raise AssertionError
    span_a, span_b = spans(a, len_a), spans(b, len_b)
    j = 0
    for s, e, x in span_a:
        while span_b[j][1] <= s:
            j += 1
        k = j
        while k < len(span_b) and span_b[k][0] < e:
            links.append((x, span_b[k][2]))
            k += 1
    return groups, links, len(a), len(b)


def spans(ids, lengths):
    at, out = 0, []
    for i, n in zip(ids, lengths, strict=True):
        out.append((at, at + n, i))
        at += n
    return out


def result(spark, rows, shards):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, keys string, chunk long")
    return [tuple(r) for r in token_pairs.aligned_documents(frame.repartition(5), ONE, TWO, shards).collect()]


@pytest.mark.parametrize("shards", [1, 7])
def test_equals_plain_python(spark, library, shards, monkeypatch):
    if shards == 7:  # small blocks, parts passed on early, shard files read again
        monkeypatch.setattr(token_pairs, "BLOCK", 3_000)
        monkeypatch.setattr(token_pairs, "KEPT_PAIRS", 50)
        monkeypatch.setattr(token_pairs, "RESIDENT", 1)
        monkeypatch.setattr(token_pairs, "FAN", 2)
        monkeypatch.setattr(token_pairs, "KNOWN", 100)
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts())]
    want = [(i, *x) for (i, _), x in zip(rows, plain([t for _, t in rows], *library), strict=True)]
    assert sum(x[1] == 0 for x in want) >= 3
    assert sorted(result(spark, rows, shards), key=repr) == sorted(want, key=repr)


def test_without_tokens(spark):
    assert sorted(result(spark, [(1, None), (2, ""), (2, "")], 4)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 2)]
    assert result(spark, [], 4) == []


def test_byte_level_ids_are_the_librarys(library):
    rnd, one = random.Random(8), token_pairs.ByteLevel(ONE)
    alphabet = "aeiou tsrn  \n\t'’0123456789.,;-é ñçß日本  \U0001f642퟿̀"
    for _ in range(3_000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60)))
        assert one.encode(" " + text).tolist() == library[0].encode(" " + text, add_special_tokens=False).ids


def test_pieces_are_encoded_as_in_the_whole_text(library):
    """Cut where a blank or line feed follows another character, both tokenizers give the ids of the whole text."""
    rnd, known = random.Random(9), token_pairs.Known(ONE, TWO)
    assert known.two.separable
    alphabet = "aeiou tsrn  \n\n\t'’0123456789.,;-é ñçß日本  \U0001f642퟿̀ﬁ①▁<0x41>\x00\u00ad"
    for _ in range(5_000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60)))
        pieces = known.cut(text)
        assert known.two.encode(" " + text) == library[1].encode(text)
        assert "".join(pieces) == " " + text
        assert [int(i) for p in pieces for i in known.one.encode(p)] == library[0].encode(" " + text, add_special_tokens=False).ids
        if "▁" not in text:  # such a text is not given back and has no tokens
            assert [i for p in pieces for i in known.two.encode(p)] == library[1].encode(text)


@pytest.mark.parametrize("n", [0, 1, 2, 1_000, 50_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).choice(10**12, n, replace=False)
    made = PerfectHash.from_buffer(PerfectHash.build(keys).to_bytes())[0]
    assert sorted(made.index(keys).tolist()) == list(range(n))
    assert made.n == n and len(made.to_bytes()) <= 0.7 * n + 200
