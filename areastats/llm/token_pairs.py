"""Alignment of two tokenizers: which tokens of one cover the same bytes as which of the other, counted over a corpus.

First pass: every document is encoded by both and each pair of ids that it links anywhere counts once. A task adds its
documents up and writes its pairs in shards by the first id. A tree of merges finds the distinct pairs of a shard, a
minimal perfect hash numbers them, and the tasks' counts become dense vectors under those numbers, which a second tree
sums. A shard's file holds the hash, the keys at their numbers and the counts. Second pass: the documents are aligned
again, and their links look up their counts; a key is compared before its count is taken.

Both tokenizers end a token where a blank or line feed follows another character: the one by its pre-splitting, the other
since none of its pieces goes on there, which is checked in its vocabulary. So a text is cut there, and a task encodes and
aligns each distinct piece once; a document's tokens, groups and links are those of its pieces.

Bounds: a block of documents holds `BLOCK` bytes of text or one longer text; a task forgets its pieces beyond `KNOWN`; a shard holds its share of the pairs of two
vocabularies, whatever the corpus; a task keeps `RESIDENT` bytes of shard files and reads the others again. Groups of a
tree have `FAN` tasks' rows.
"""

from __future__ import annotations

import hashlib
import json
import struct
from array import array
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import materialise
from areastats.llm.files import new_folder, own_name, place
from areastats.llm.perfect_hash import PerfectHash
from areastats.llm.token_files import ODD, PIECE, byte_letters

BLOCK = 4 << 20
RESIDENT = 128 << 20
KNOWN, KNOWN_BYTES = 500_000, 48 << 20
TOGETHER = 512
KEPT_PAIRS = 3_000_000
SHARDS = 128
FAN = 32
TEXT_BITS = 30
#: Fixed value: the public pre-splitting pattern of the byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class ByteLevel:
    """A byte-level BPE vocabulary file: ids of texts and the bytes of each id.

    The file's merges, in its order, are the ranks of the encoder; the results are the file's ids. Strings of special
    tokens inside a text are plain text.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte_of = {c: b for b, c in byte_letters().items()}

        def raw(token: str) -> bytes:
            return bytes(byte_of[c] for c in token)

        tokens = [t for _, t in sorted((b, c) for c, b in byte_of.items())]
        tokens += ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ranks: dict[bytes, int] = {}
        for t in tokens:
            ranks.setdefault(raw(t), len(ranks))
        self.encoder = tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        ids = {raw(t): model["vocab"][t] for t in tokens}
        self.ids = np.array([ids[b] for b in ranks], dtype=np.int64)
        self.size = int(self.ids.max()) + 1
        self.bytes = [b""] * self.size
        for b, i in ids.items():
            self.bytes[i] = b
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)

    def encode(self, text: str) -> np.ndarray:
        return self.ids[self.encoder.encode_to_numpy(text, disallowed_special=())]


class Pieces:
    """A sentencepiece model file, which puts a space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.model.id_to_piece(list(range(self.size))))
        ]
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.blank = self.model.piece_to_id("▁")
        normal = [self.model.id_to_piece(i) for i in range(self.size) if not (self.model.is_byte(i) or self.model.is_control(i))]
        #: No token goes on behind another character with a blank or line feed.
        self.separable = not any("\n" in p or "▁" in p.lstrip("▁") for p in normal)

    def encode(self, text: str) -> list[int]:
        """Of a text that starts with a blank or a line feed, without a further space."""
        if text == " ":
            return [self.blank]
        return self.model.encode(text[1:]) if text[0] == " " else self.model.encode(text)[1:]


def distinct(values: np.ndarray) -> np.ndarray:
    """Ascending, of values from 0."""
    ordered = np.sort(values)
    return ordered[np.flatnonzero(np.diff(ordered, prepend=-1))]


def encoded(pieces: list[str], one: ByteLevel, two: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of both and the pieces that they belong to, of all pieces whose bytes both give back.

    Pieces that are a word behind blanks and line feeds follow each other as in a text, so many go into one call; where a call does not give
    back its bytes, and for the other pieces, it is one call each.
    """
    out: list[list[np.ndarray]] = [[], [], [], []]

    def take(which: list[int], text: str) -> bool:
        whole, a, b = text.encode(), one.encode(text), two.encode(text)
        # Tokens of `one` are runs of the text's own bytes, so the same number of bytes is the same bytes.
        if one.lengths[a].sum() != len(whole) or b"".join(map(two.bytes.__getitem__, b)) != whole:
            return False
        b = np.array(array("i", b), dtype=np.int64)
        sizes = [len(whole)] if len(which) == 1 else [len(pieces[i].encode()) for i in which]
        own = np.array(which, np.int64)
        for x, ids, lengths in ((0, a, one.lengths), (1, b, two.lengths)):
            out[x].append(ids)
            out[x + 2].append(own[np.searchsorted(np.cumsum(sizes), np.cumsum(lengths[ids]))])
        return True

    plain = [i for i, p in enumerate(pieces) if p.split() == [p.lstrip(" \n")]] if two.separable else []
    joined = [plain[x : x + TOGETHER] for x in range(0, len(plain), TOGETHER)]
    alone = sorted(set(range(len(pieces))).difference(plain))
    for which in joined:
        if not take(which, "".join(map(pieces.__getitem__, which))):
            alone += which
    for i in alone:
        take([i], pieces[i])
    a, b, text_a, text_b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in out)
    order_a, order_b = np.argsort(text_a, kind="stable"), np.argsort(text_b, kind="stable")
    return a[order_a], b[order_b], text_a[order_a], text_b[order_b]


class Aligned:
    """The tokens of some pieces of text, one after the other, as positions in their joined bytes."""

    def __init__(self, pieces: list[str], one: ByteLevel, two: Pieces):
        self.n, self.size = len(pieces), max(one.size, two.size)
        self.a, self.b, self.text_a, self.text_b = encoded(pieces, one, two)
        self.good = distinct(self.text_a)
        end_a, end_b = np.cumsum(one.lengths[self.a]), np.cumsum(two.lengths[self.b])
        size = int(end_a[-1]) if len(self.a) else 0
        ends = np.zeros(size + 1, np.int32)
        ends[end_b] = 1
        self.last_a = ends[end_a] == 1
        passed = np.cumsum(ends, dtype=np.int32)  # tokens of b that end at or before a position
        self.last_b = np.zeros(len(self.b), bool)
        self.last_b[passed[end_a[self.last_a]] - 1] = True
        first = passed[np.concatenate([[0], end_a[:-1]])] if len(self.a) else end_a
        many = passed[end_a - 1] + 1 - first
        at = np.cumsum(many) - many
        self.link_a = np.repeat(np.arange(len(self.a)), many)
        self.link_b = np.arange(len(self.link_a)) - np.repeat(at - first, many)

    def pairs(self, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (piece of text, pair of ids), in order, with the number of links of each."""
        key = self.a[self.link_a] * size_b + self.b[self.link_b]
        order = np.lexsort([key, self.text_a[self.link_a]])
        key, text = key[order], self.text_a[self.link_a][order]
        first = np.flatnonzero((np.diff(key, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
        return text[first], key[first], np.diff(np.append(first, len(key)))

    def group_texts(self) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of every piece of text; empty for those without tokens."""
        out = [b""] * self.n
        if not len(self.good):
            return out
        groups_a, groups_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        size_a, size_b = np.bincount(groups_a), np.bincount(groups_b)
        before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        place_a = np.arange(len(self.a)) + before_b[groups_a]
        place_b = np.arange(len(self.b)) + (before_a + size_a)[groups_b]
        last_of_text = np.append(np.diff(self.text_b) != 0, True)
        token, text = np.empty(len(self.a) + len(self.b), np.int64), np.empty(len(self.a) + len(self.b), np.int64)
        token[place_a], text[place_a] = 4 * self.a + self.last_a, self.text_a
        token[place_b], text[place_b] = 4 * self.b + np.where(last_of_text, 3, 2 * self.last_b), self.text_b
        cells, sizes = digits(self.size)
        ends = np.cumsum(sizes[token])[np.searchsorted(text, self.good, side="right") - 1].tolist()
        wide = cells[token].view(np.uint8)
        joined, start = wide[wide != 0].tobytes(), 0
        for i, end in zip(self.good.tolist(), ends, strict=True):
            out[i] = joined[start:end]
            start = end
        return out


class Known:
    """The pieces a task has met, each encoded and aligned once."""

    def __init__(self, one: str, two: str):
        self.one, self.two = ByteLevel(one), Pieces(two)
        self.forget()

    def forget(self) -> None:
        none = np.zeros(0, np.int64)
        self.place: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.bytes = 0
        #: By piece: whether it has tokens, tokens of both, groups, links; where its pairs start.
        self.facts, self.starts = np.zeros((5, 0), np.int64), np.zeros(1, np.int64)
        self.keys, self.links = none, none

    def cut(self, text: str) -> list[str]:
        whole = " " + text
        return [whole] if not self.two.separable or ODD.search(text) else PIECE.findall(whole)

    def met(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(text, piece) of every piece of some texts; new pieces get to be known."""
        if len(self.place) > KNOWN or self.bytes > KNOWN_BYTES:
            self.forget()
        own = [self.cut(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(own))
        new = list(set(flat).difference(self.place))
        if new:
            self.add(new)
        text = np.repeat(np.arange(len(texts)), np.array([len(x) for x in own], np.int64))
        return text, np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))

    def add(self, new: list[str]) -> None:
        for p in new:
            self.place[p] = len(self.place)
            self.bytes += len(p)
        made, n = Aligned(new, self.one, self.two), len(new)
        self.texts += made.group_texts()
        self.bytes += sum(map(len, self.texts[-n:]))
        text, key, links = made.pairs(self.two.size)
        facts = [
            np.isin(np.arange(n), made.good), np.bincount(made.text_a, minlength=n), np.bincount(made.text_b, minlength=n),
            np.bincount(made.text_a[made.last_a], minlength=n), np.bincount(made.text_a[made.link_a], minlength=n),
        ]
        self.facts = np.concatenate([self.facts, np.array(facts, np.int64)], axis=1)
        self.starts = np.append(self.starts, len(self.keys) + np.cumsum(np.bincount(text, minlength=n)))
        self.keys, self.links = np.append(self.keys, key), np.append(self.links, links)

    def good(self, n: int, text: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Which of n texts have tokens: those all of whose pieces have."""
        return (np.bincount(text, minlength=n) > 0) & (np.bincount(text[self.facts[0][piece] == 0], minlength=n) == 0)

    def documents_of_pairs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of some texts, ascending, with the number of texts that hold each."""
        text, piece = self.met(texts)
        kept = self.good(len(texts), text, piece)[text]
        both = distinct(text[kept] << TEXT_BITS | piece[kept])
        text, piece = both >> TEXT_BITS, both & ((1 << TEXT_BITS) - 1)
        many = self.starts[piece + 1] - self.starts[piece]
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - self.starts[piece], many)
        held = distinct(self.keys[at] << TEXT_BITS | np.repeat(text, many)) >> TEXT_BITS
        first = np.flatnonzero(np.diff(held, prepend=-1))
        return held[first], np.diff(np.append(first, len(held)))


@lru_cache(1)
def digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal numbers below `size`, each with every mark behind it, padded with zero bytes, and their sizes."""
    cells = np.array([f"{i}{mark}" for i in range(size) for mark in (",", "|", ";", "")], dtype="S")
    return cells, np.char.str_len(cells)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(ids, texts) of bounded runs of documents; a longer text is a block of its own."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for d, t in zip(batch.column(0), batch.column(1), strict=True):
            text = t.as_py()
            more = len(text) if text else 0
            if ids and (size + more > BLOCK or len(ids) >= 1 << 14):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(d.as_py())
            texts.append(text)
            size += more
    if ids:
        yield ids, texts


def split(values: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Each distinct value with the places that have it, in order."""
    order = np.argsort(values, kind="stable")
    edges = np.flatnonzero(np.diff(values[order], prepend=-1, append=-1))
    return [(int(values[order[x]]), order[x:y]) for x, y in zip(edges, edges[1:], strict=False)]


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(count, first) if len(first) else count


def pair_counts(docs: DataFrame, one: str, two: str, shards: int) -> DataFrame:
    """First pass: (shard, chunk, keys, counts), a task's documents added up; a key is first id * size + second id."""

    def rows(keys: np.ndarray, counts: np.ndarray, size_b: int) -> pa.RecordBatch:
        parts = split(keys // size_b % shards)
        columns = [
            pa.array([s for s, _ in parts], pa.int32()), pa.array([TaskContext.get().partitionId()] * len(parts), pa.int64()),
            pa.array([keys[p].astype("<i8").tobytes() for _, p in parts], pa.binary()),
            pa.array([counts[p].astype("<i8").tobytes() for _, p in parts], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "chunk", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, keys, counts, held = Known(one, two), [], [], 0
        for _, texts in blocks(batches):
            key, count = known.documents_of_pairs(texts)
            keys.append(key)
            counts.append(count)
            held += len(key)
            if held > KEPT_PAIRS:
                keys, counts = ([x] for x in summed(keys, counts))
                held = len(keys[0])
                if 2 * held > KEPT_PAIRS:
                    yield rows(keys[0], counts[0], known.two.size)
                    keys, counts, held = [], [], 0
        if held:
            yield rows(*summed(keys, counts), known.two.size)

    two_columns = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return two_columns.mapInArrow(run, "shard int, chunk long, keys binary, counts binary")


def numbers(cells) -> list[np.ndarray]:
    return [np.frombuffer(x, "<i8") for x in cells]


def folded(rows: DataFrame, fold, chunks: int) -> DataFrame:
    """One row for each shard: rounds of groups of FAN neighbouring chunks, each group made one row by `fold`."""
    while chunks > 1:
        chunks = -(-chunks // FAN)
        grouped = rows.withColumn("chunk", F.expr(f"chunk div {FAN}")).groupBy("shard", "chunk")
        rows = materialise(grouped.applyInPandas(fold, rows.schema))
    return rows


def distinct_pairs(counted: DataFrame, chunks: int) -> DataFrame:
    """(shard, keys, hash): the distinct pairs of every shard, ascending, and their minimal perfect hash."""

    def union(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(np.concatenate(numbers(pdf["keys"])))
        return pd.DataFrame([(pdf["shard"].iloc[0], pdf["chunk"].iloc[0], keys.tobytes())], columns=["shard", "chunk", "keys"])

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            made = [PerfectHash.build(k).to_bytes() for k in numbers(pdf["keys"])]
            yield pdf.assign(hash=made)[["shard", "keys", "hash"]]

    # Even a single task may have passed on several parts, so there is one round at least.
    keys = folded(counted.select("shard", "chunk", "keys"), union, max(2, chunks))
    return materialise(keys.mapInPandas(hashed, "shard int, keys binary, hash binary"))


def dense_counts(counted: DataFrame, distinct: DataFrame, chunks: int) -> DataFrame:
    """(shard, chunk, counts): one vector for each shard, the documents of every pair at its number."""

    def dense(parts: pd.DataFrame, made: pd.DataFrame) -> pd.DataFrame:
        if not len(parts):
            return pd.DataFrame({"shard": [], "chunk": [], "counts": []})
        perfect = PerfectHash.from_buffer(made["hash"].iloc[0])[0]
        total = np.zeros(perfect.n, np.int64)
        for keys, counts in zip(numbers(parts["keys"]), numbers(parts["counts"]), strict=True):
            total[perfect.index(keys)] += counts  # distinct within a part, so no number comes twice
        return pd.DataFrame([(parts["shard"].iloc[0], parts["chunk"].iloc[0], total.tobytes())], columns=["shard", "chunk", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(numbers(pdf["counts"]), axis=0)
        return pd.DataFrame([(pdf["shard"].iloc[0], pdf["chunk"].iloc[0], total.tobytes())], columns=["shard", "chunk", "counts"])

    groups = -(-chunks // FAN)
    parts = counted.withColumn("chunk", F.expr(f"chunk div {FAN}"))
    each = distinct.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("chunk"), "hash")
    both = parts.groupBy("shard", "chunk").cogroup(each.groupBy("shard", "chunk"))
    vectors = materialise(both.applyInPandas(dense, "shard int, chunk long, counts binary"))
    return folded(vectors, add, groups)


def write_tables(distinct: DataFrame, dense: DataFrame) -> dict[int, str]:
    """A file for each shard; returns their names. A first id has all its pairs in one shard, so its highest is known there."""
    folder = new_folder(distinct.sparkSession, "token-pairs")

    def run(pdf: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        out = []
        for shard, blob, keys, counts in zip(pdf["shard"], pdf["hash"], numbers(pdf["keys"]), numbers(counted["counts"]), strict=True):
            perfect = PerfectHash.from_buffer(blob)[0]
            at = np.empty(perfect.n, np.int64)
            at[perfect.index(keys)] = keys
            name = own_name(folder, shard, ".pairs")
            fs, path = place(name)
            with fs.open_output_stream(path, compression=None) as f:
                for part in (struct.pack("<Q", perfect.n), at.tobytes(), counts.tobytes(), blob):
                    f.write(part)
            out.append((shard, name))
        return pd.DataFrame(out, columns=["shard", "file"])

    files = distinct.groupBy("shard").cogroup(dense.groupBy("shard")).applyInPandas(run, "shard int, file string")
    return {r["shard"]: r["file"] for r in files.collect()}


class Tables:
    """Counts of pairs from the shard files, of which so many are kept in memory as RESIDENT allows."""

    def __init__(self, files: dict[int, str], size_b: int, shards: int):
        self.files, self.size_b, self.shards = files, size_b, shards
        self.held, self.bytes = OrderedDict(), 0

    def shard(self, number: int) -> tuple[PerfectHash, np.ndarray, np.ndarray, np.ndarray]:
        if number not in self.held:
            fs, path = place(self.files[number])
            with fs.open_input_stream(path, compression=None) as f:
                data = f.read()
            (n,) = struct.unpack_from("<Q", data)
            keys, counts = np.frombuffer(data, "<i8", n, 8), np.frombuffer(data, "<i8", n, 8 + 8 * n)
            first, which = np.unique(keys // self.size_b, return_inverse=True)
            highest = np.zeros(len(first), np.int64)
            np.maximum.at(highest, which, counts)
            self.held[number] = (PerfectHash.from_buffer(data, 8 + 16 * n)[0], keys, counts, counts == highest[which]), len(data)
            self.bytes += len(data)
            while self.bytes > RESIDENT and len(self.held) > 1:
                self.bytes -= self.held.popitem(last=False)[1][1]
        self.held.move_to_end(number)
        return self.held[number][0]

    def of_pieces(self, known: Known, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of some pieces, repeats included, its links to a highest pair and the sum of its links' counts."""
        own, which = np.unique(piece, return_inverse=True)
        many = known.starts[own + 1] - known.starts[own]
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - known.starts[own], many)
        key, back = np.unique(known.keys[at], return_inverse=True)
        count, best = self.look_up(key)
        place, links, sums = np.repeat(np.arange(len(own)), many), known.links[at], np.zeros((2, len(own)), np.int64)
        np.add.at(sums[0], place, links * best[back])
        np.add.at(sums[1], place, links * count[back])
        return sums[0][which], sums[1][which]

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents that hold the pair, whether that is its first id's highest) of distinct keys."""
        count, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        for s, own in split(keys // self.size_b % self.shards):
            perfect, kept, counts, highest = self.shard(s)
            number = perfect.index(keys[own])
            if not np.array_equal(kept[number], keys[own]):
                raise ValueError("a pair of the second pass is missing in the first: the documents changed in between")
            count[own], best[own] = counts[number], highest[number]
        return count, best


def aligned_documents(docs: DataFrame, one: str, two: str, shards: int = SHARDS) -> DataFrame:
    """Per row of `docs` the tokens, groups and links of its alignment, with the corpus counts of its pairs of ids.

    `one` is the path of a byte-level vocabulary file, `two` that of a sentencepiece model; every worker reads them.
    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no tokens: zeros and ''.
    Repeated rows count each; null ids are kept; a long text is one block; an empty table gives no rows. Other columns are
    not looked at. The pairs of a frequent token lie in one shard, whose size the vocabularies bound.
    """
    counted = materialise(pair_counts(docs, one, two, shards))
    last = counted.agg(F.max("chunk")).first()[0]
    files = {}
    if last is not None:
        distinct = distinct_pairs(counted, last + 1)
        files = write_tables(distinct, dense_counts(counted, distinct, last + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(one, two)
        tables = Tables(files, known.two.size, shards)
        for ids, texts in blocks(batches):
            n, (text, piece) = len(texts), known.met(texts)
            good = known.good(n, text, piece)
            text, piece = text[good[text]], piece[good[text]]
            sums = tables.of_pieces(known, piece)
            columns = [np.bincount(text, weights=x[piece], minlength=n).astype(np.int64) for x in known.facts[1:]]
            for x in sums:  # whole numbers of any size, so no weights of doubles
                columns.append(np.zeros(n, np.int64))
                np.add.at(columns[-1], text, x)
            digests, edges = [""] * n, np.searchsorted(text, np.arange(n + 1))
            for i in np.flatnonzero(good).tolist():
                whole = b";".join(map(known.texts.__getitem__, piece[edges[i] : edges[i + 1]].tolist()))
                digests[i] = hashlib.sha256(whole).hexdigest()
            arrays = [pa.array(ids, pa.int64()), *[pa.array(c) for c in columns], pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in RESULT.split(", ")])

    two_columns = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return two_columns.mapInArrow(run, RESULT)
