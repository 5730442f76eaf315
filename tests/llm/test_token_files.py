"""Token files against the tokenizers library: any text, added tokens in texts, null and repeated ids, single reads."""

import random
import zlib
from array import array

import numpy as np
import pytest

from areastats.llm import token_files
from areastats.llm.elias_fano import EliasFano
from areastats.llm.files import place

public_tokenizers = pytest.importorskip("public_tokenizers")
PARTS = [
    "a", "bc", " the", "Word", "'s", "é", "日本", "1", "23", ".", ",", "!?", "ab%%&", "x.", "z._", "😀", " ", "  ", "\n",
    "\n\n", "x\ny", "\t", "\r\n", "\x1c", "\x85", "\xa0", "　", "​", "<|endoftext|>",
]


@pytest.fixture(scope="module")
def vocabulary():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def library_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_are_the_librarys_ids(vocabulary, tokenizer):
    draw, pieces = random.Random(5), token_files.Pieces(vocabulary, "H", most=50)
    for _ in range(5_000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randrange(14)))
        assert pieces.ids(text) == array("H", library_ids(tokenizer, text)).tobytes(), repr(text)


def test_added_token_in_a_text_is_the_librarys(vocabulary, tokenizer):
    text = "a <|endoftext|> b"
    assert 50_256 in library_ids(tokenizer, text)
    assert token_files.Pieces(vocabulary, "H").ids(text) == array("H", library_ids(tokenizer, text)).tobytes()


ROWS = [(None, "no id"), (7, "same row"), (7, "same row"), (7, "other text of the id"), (-4, "<|endoftext|>"), (9, None)]
ROWS += [(None, ""), (12, "long text. " * 20_000), (2**40, "far id")]


def rows_of(spark):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in ROWS], "doc_id long, text string, start int, part string")


def test_null_repeated_and_long_rows(spark, vocabulary, tokenizer):
    got = token_files.round_trip(rows_of(spark), vocabulary, rows_per_file=2).collect()
    want = [(i, [*library_ids(tokenizer, t), 0]) for i, t in ROWS]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(
        ((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in want), key=key
    )
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_one_document_is_read_by_select(spark, vocabulary, tokenizer):
    found = {}
    for m in token_files.write_tokens(rows_of(spark), vocabulary, rows_per_file=100).collect():
        fs, path = place(m["file"])
        with fs.open_input_file(path) as f:
            tokens = token_files.TokenFile(f)
            found |= {i: [x.tolist() for x in tokens.documents(i)] for i in (7, -4, 2**40, 9, 8, 11)}
    want = {i: sorted([*library_ids(tokenizer, t), 0] for d, t in ROWS if d == i) for i in found}
    assert {i: sorted(x) for i, x in found.items()} == want and found[8] == []


def test_broken_file_is_refused(spark, tmp_path):
    import pyarrow.fs as pafs

    (tmp_path / "x.tok").write_bytes(b"\0" * 100)
    with pafs.LocalFileSystem().open_input_file(str(tmp_path / "x.tok")) as f, pytest.raises(ValueError):
        token_files.TokenFile(f)


def test_no_rows(spark, vocabulary):
    assert token_files.round_trip(rows_of(spark).limit(0), vocabulary).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_select_gives_every_value(seed):
    draw = np.random.default_rng(seed)
    values = np.sort(draw.integers(0, 10 ** (seed + 2), 1_500).astype(np.uint64))
    coded, _ = EliasFano.from_buffer(EliasFano.build(values).to_bytes())
    assert [coded.select(i) for i in range(len(values))] == values.tolist() == coded.all().tolist()
