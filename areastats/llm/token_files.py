"""Token ids in binary files with Elias-Fano document boundaries.

A file holds the ids of its documents one after the other, each document ended by the end id, then the boundaries (where
each document starts, and the end) and the document ids, both ascending and Elias-Fano coded, and a footer. A document's
offset is one select; no table of 64-bit offsets exists. Files are numbered by ascending doc_id.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import small_frame
from areastats.llm.elias_fano import EliasFano
from areastats.llm.files import new_folder, own_name, place

MAGIC = b"AREATOK1"
#: documents, of them with null id, ids, smallest doc_id, bytes of an id, bytes of boundaries, bytes of doc ids, magic
FOOT = "<QQQqBQQ8s"
#: White space other than blanks and line feeds: such a text is encoded in one piece.
ODD = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")
PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Punctuation that the pre-splitting parts from letters before it whatever follows; an apostrophe may belong to both.
MARKS = string.punctuation.replace("'", "")
TWO_WHITE = ("  ", " \n", "\n ", "\n\n")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes are themselves, the others the characters from 256 on in turn."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class OddSpace(Exception):
    """A piece holds white space other than blanks and line feeds."""


class Pieces(dict):
    """Ids, as bytes, of the words that follow a blank, encoded once each in a worker.

    A text is cut where a blank or line feed follows another character: there the tokenizer's own pre-splitting cuts too,
    so the pieces' ids are the text's ids. Two kinds of text go to the library's encode whole: those with other white
    space, and those that hold the string of an added token, which the library takes for that token.
    """

    def __init__(self, path: str, code: str, most: int = 1_000_000):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.code, self.most, self.other = code, most, {}

    def model_ids(self, mapped: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def encode(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, piece: str) -> bytes:
        """A piece as PIECE cuts it, encoded. A blank and letters are one pre-split word, the model's own input."""
        if piece[0] == " " and piece[1:].isalpha():
            return self.model_ids(piece.encode().decode("latin-1").translate(self.letters))
        if ODD.search(piece):
            raise OddSpace
        return self.encode(piece)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        if word[:1] == "\n":  # stands for itself, without a blank before
            ids = self.cut("\n") + self.cut(word[1:])
        elif (bare := word.rstrip(MARKS)) != word and bare.isalpha():
            ids = self[bare] + self.cached(word[len(bare) :])  # punctuation is a piece of its own behind a letter
        else:
            ids = self.piece(" " + word)
        self[word] = ids
        return ids

    def cached(self, piece: str) -> bytes:
        """A piece that follows no blank, or is white space alone."""
        ids = self.other.get(piece)
        if ids is None:
            if len(self.other) >= self.most:
                self.other.clear()
            ids = self.other[piece] = self.piece(piece)
        return ids

    def cut(self, text: str) -> bytes:
        """The pieces of any text without odd white space, one after the other."""
        ids = []
        for piece in PIECE.findall(text):
            if piece[0] == " " and len(piece) > 1 and piece[1] not in " \n":
                ids.append(self[piece[1:]])
                continue
            ids.append(self.cached(piece))
        return b"".join(ids)

    def ids(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return self.encode(text)
        try:
            if any(two in text for two in TWO_WHITE):
                return self.cut(text)
            first, *words = text.replace("\n", " \n").split(" ")  # each blank or line feed starts a piece
            return self.cut(first) + b"".join(map(self.__getitem__, words))
        except OddSpace:
            return self.encode(text)


@lru_cache(1)
def worker_pieces(path: str, code: str) -> Pieces:
    """The worker's own pieces, kept from task to task."""
    return Pieces(path, code)


def tokenised(docs: DataFrame, vocabulary: str, bounds: list[int], width: int) -> DataFrame:
    """(part, doc_id, ids) of every row; ids as little-endian bytes, without the end id. part is the file it goes to."""
    code = "H" if width == 2 else "I"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, edges = worker_pieces(vocabulary, code), np.array(bounds, dtype=np.int64)
        for batch in batches:
            part = np.searchsorted(edges, batch.column(0).fill_null(-(2**63)).to_numpy(zero_copy_only=False), side="right")
            for at in range(0, batch.num_rows, 512):
                ids = [pieces.ids(t.as_py() or "") for t in batch.column(1).slice(at, 512)]
                columns = [pa.array(part[at : at + 512], pa.int32()), batch.column(0).slice(at, 512), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "ids"])

    two = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return two.mapInArrow(run, "part int, doc_id long, ids binary")


class FileWriter:
    def __init__(self, folder: str, number: int, width: int, end_id: int):
        self.name = own_name(folder, number, ".tok")
        fs, path = place(self.name)
        self.out, self.width = fs.open_output_stream(path, compression=None), width
        self.end = int(end_id).to_bytes(width, "little")
        self.starts, self.doc_ids, self.nulls = [0], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.out.write(self.end)
        self.starts.append(self.starts[-1] + len(ids) // self.width + 1)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> None:
        least = self.doc_ids[0] if self.doc_ids else 0
        a = EliasFano.build(np.array(self.starts, dtype=np.uint64)).to_bytes()
        b = EliasFano.build(np.array([d - least for d in self.doc_ids], dtype=np.uint64)).to_bytes()
        self.out.write(a)
        self.out.write(b)
        self.out.write(struct.pack(FOOT, len(self.starts) - 1, self.nulls, self.starts[-1], least, self.width, len(a), len(b), MAGIC))
        self.out.close()


def write_tokens(
    docs: DataFrame, vocabulary: str, end_id: int = 0, vocabulary_size: int = 50_257, rows_per_file: int = 4_096
) -> DataFrame:
    """Write the token files of `docs` and return their manifest: part, file, n_docs, n_tokens.

    Files take ranges of doc_id cut at approximate quantiles, about `rows_per_file` rows each. Only the ids are shuffled,
    and a task streams them to its files in sorted order.
    """
    spark, width = docs.sparkSession, 2 if vocabulary_size <= 1 << 16 else 4
    folder = new_folder(spark, "tokens")
    doc_id = docs["doc_id"].cast("long")
    files = max(1, -(-docs.count() // rows_per_file))
    cuts = [i / files for i in range(1, files)]
    found = docs.agg(F.percentile_approx(doc_id, cuts, 100 * files)).first()[0] if cuts else None
    bounds = sorted(set(found or []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, now, done = None, None, []
        for batch in batches:
            for part, d, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now:
                    if writer:
                        writer.close()
                        done.append((now, writer.name, len(writer.starts) - 1, writer.starts[-1]))
                    writer, now = FileWriter(folder, part, width, end_id), part
                writer.add(d, ids)
        if writer:
            writer.close()
            done.append((now, writer.name, len(writer.starts) - 1, writer.starts[-1]))
            columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), [pa.int32(), pa.string(), pa.int64(), pa.int64()], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "file", "n_docs", "n_tokens"])

    parted = tokenised(docs, vocabulary, bounds, width).repartition("part").sortWithinPartitions("part", "doc_id", "ids")
    return parted.mapInArrow(run, "part int, file string, n_docs long, n_tokens long")


def read_tokens(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the files (file, base: ids in all files before)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from read_file(file, base)

    return files.select("file", "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


class TokenFile:
    """One token file opened for reading. Only its footer and its two Elias-Fano lists are loaded."""

    def __init__(self, f):
        size, foot = f.size(), struct.calcsize(FOOT)
        self.f = f
        self.n, self.nulls, n_tokens, self.least, self.width, a, b, magic = struct.unpack(FOOT, f.read_at(foot, size - foot))
        if magic != MAGIC or n_tokens * self.width + a + b + foot != size:
            raise ValueError("no whole token file")
        self.bounds, _ = EliasFano.from_buffer(f.read_at(a, n_tokens * self.width))
        self.doc_ids, _ = EliasFano.from_buffer(f.read_at(b, n_tokens * self.width + a))

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.doc_ids.select(i - self.nulls)

    def start(self, i: int) -> int:
        """Ids before document i: one select."""
        return self.bounds.select(i)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from `start` to `stop` as unsigned 32-bit numbers."""
        data = self.f.read_at((stop - start) * self.width, start * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def documents(self, doc_id: int) -> list[np.ndarray]:
        """The ids of each row of a document, found without reading any other row."""
        found = []
        i = self.nulls + self.doc_ids.successor(doc_id - self.least)
        while i < self.n and self.doc_id(i) == doc_id:
            found.append(self.ids(self.start(i), self.start(i + 1)))
            i += 1
        return found


def read_file(file: str, base: int, docs_at_once: int = 2_048) -> Iterator[pa.RecordBatch]:
    fs, path = place(file)
    with fs.open_input_file(path) as f:
        tokens = TokenFile(f)
        for at in range(0, tokens.n, docs_at_once):
            here = range(at, min(tokens.n, at + docs_at_once))
            edges = [tokens.start(i) for i in (*here, here.stop)]
            data = tokens.ids(edges[0], edges[-1])
            crc = [zlib.crc32(data[x - edges[0] : y - edges[0]].tobytes()) for x, y in pairwise(edges)]
            rows = [[tokens.doc_id(i) for i in here], [base + x for x in edges[:-1]], [y - x for x, y in pairwise(edges)], crc]
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def round_trip(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write `docs` as token files and read them back.

    Null and empty texts are the end id alone; long texts are encoded whole; null ids come first; repeated rows and ties of
    an id are kept, ordered by their token ids; no rows give no files and no rows. Other columns are not looked at. The manifest, one row per file, comes to the driver to
    number the files' bases.
    """
    spark = docs.sparkSession
    rows, base = [], 0
    for r in sorted(write_tokens(docs, vocabulary, **options).collect(), key=lambda r: r["part"]):
        rows.append({"file": r["file"], "base": base})
        base += r["n_tokens"]
    tasks = max(1, min(len(rows), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return read_tokens(small_frame(spark, rows, "file string, base bigint").repartition(tasks))
