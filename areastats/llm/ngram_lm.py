"""Language-model scores from an Elias-Fano bigram trie in shards.

The most frequent words (the head, a bounded number) get short ids; their counts and backoff weights are the trie's first
level and go to every task. The second level holds the successors of each context, in shards by context, hot contexts
spread over sixteen: monotone pointers from a context to its successors, the successors as one ascending Elias-Fano list,
and smoothed probabilities quantised to a byte. A shard is a few buffers without objects, so it can be mapped from a file
and queried in place; bulk queries decode a shard once.

    p(b | a) = (n(a, b) - D) / n(a) + backoff(a) * p(b)   for pairs seen often enough, else   backoff(a) * p(b)

p(b) is the add-0.1 unigram probability, and backoff(a) is the mass that the kept pairs leave, so each context sums to 1.
Counts and scores travel packed: one row for each block of documents and bucket, whose arrays are sorted and looked up at
once. Words outside the head get their exact counts and backoff weights from the bucket of their hash, and pairs with such
a word have shards of their own, by hashes in place of ids, so every pair seen often enough counts whatever its words.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cached_property, reduce
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import label_hash, materialise
from areastats.llm.elias_fano import EliasFano

HEAD = 1 << 16
END = 0
ADD = 0.1
DISCOUNT = 0.75
LEAST = 2
BLOCK_DOCS, BLOCK_BYTES = 2_000, 8 << 20
PACK = "bucket int, kind int, block long, a binary, b binary, c binary"
ANSWER = "block long, kind int, docs binary, base binary, known binary, model binary"
STORE = ["h", "n", "trie", "rare", "contexts", "backoffs"]
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def bucket_of_word(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> np.uint64(17)) % np.uint64(buckets)


def bucket_of_pair(key: np.ndarray, buckets: int) -> np.ndarray:
    """By context and four bits of the successor."""
    place = (key.astype(np.uint64) >> np.uint64(16) << np.uint64(4)) | (key.astype(np.uint64) & np.uint64(15))
    return (place * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(buckets)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, pa.Array]]:
    """(ids, held-out flags, texts) of bounded runs of documents; a longer text is a block of its own."""
    kept, docs, size = [], 0, 0

    def block() -> tuple[list, list, pa.Array]:
        ids, held, texts = (pa.concat_arrays([b.column(c) for b in kept]) for c in range(3))
        return ids.to_pylist(), held.to_pylist(), texts

    for batch in batches:
        first = 0
        for i, own in enumerate(pc.binary_length(batch.column(2)).fill_null(0).to_pylist()):
            if docs and (docs >= BLOCK_DOCS or size + own > BLOCK_BYTES):
                kept.append(batch.slice(first, i - first))
                yield block()
                kept, docs, size, first = [], 0, 0, i
            docs += 1
            size += own
        kept.append(batch.slice(first))
    if docs:
        yield block()


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lower-cased words of some texts, with the number of the word and the document of every occurrence.

    White space at the ends leaves empty pieces; these occur nowhere, though the empty word may be among the words.
    """
    pieces = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    coded = pieces.flatten().dictionary_encode()
    code, doc = coded.indices.to_numpy(), np.repeat(np.arange(len(texts), dtype=np.int32), pieces.value_lengths().to_numpy())
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:
        real = code != blank
        code, doc = code[real], doc[real]
    return coded.dictionary, code, doc


def packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "kind", "block", "a", "b", "c"])


def dealt(bucket: np.ndarray, kind: int, block: int, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> list[tuple]:
    """One row for each bucket that has entries."""
    # Numbers of 16 bits are sorted by radix.
    order = np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 1 << 16 else bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    out = []
    for x, y in zip(edges, edges[1:], strict=False):
        own = order[x:y]
        out.append((int(bucket[own[0]]), kind, block, a[own].tobytes(), b[own].tobytes(), c[own].tobytes()))
    return out


def word_hashes(words: pa.Array) -> np.ndarray:
    """XXH64 of the words of a dictionary, straight from its buffers."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1].tolist() if len(words) else [0]
    data = data.to_pybytes() if data is not None else b""
    return np.fromiter((xxhash.xxh64_intdigest(data[i:j]) for i, j in pairwise(ends)), dtype=np.uint64, count=len(words))


class Trie:
    """One shard of the second level over a buffer: contexts, pointers, successors, quantised log10 probabilities."""

    def __init__(self, data, at: int = 0, bits: int = 16):
        self.bits = bits
        self.contexts, at = EliasFano.from_buffer(data, at)
        self.pointers, at = EliasFano.from_buffer(data, at)
        self.successors, at = EliasFano.from_buffer(data, at)
        n, m = struct.unpack_from("<II", data, at)
        self.book = np.frombuffer(data, "<f4", m, at + 8)
        self.codes = np.frombuffer(data, np.uint8, n, at + 8 + 4 * m)

    @staticmethod
    def build(keys: np.ndarray, log_p: np.ndarray, bits: int = 16) -> bytes:
        """From ascending pair keys (context << bits | successor) and log10 probabilities."""
        contexts, counts = np.unique(keys >> bits, return_counts=True)
        rank = np.repeat(np.arange(len(contexts), dtype=np.uint64), counts)
        pointers = np.concatenate([[0], np.cumsum(counts)])
        order = np.argsort(log_p, kind="stable")
        code = np.empty(len(keys), dtype=np.uint8)
        code[order] = np.arange(len(keys)) * 256 // max(1, len(keys))
        n = np.bincount(code, minlength=256)
        book = (np.bincount(code, weights=log_p, minlength=256) / np.maximum(n, 1)).astype("<f4")
        lists = [EliasFano.build(x).to_bytes() for x in (contexts, pointers, rank << np.uint64(bits) | (keys & (1 << bits) - 1).astype(np.uint64))]
        return b"".join(lists) + struct.pack("<II", len(keys), len(book)) + book.tobytes() + code.tobytes()

    def log_p(self, context: int, successor: int) -> float | None:
        """By successor search among the context's own successors; None if the pair is not kept."""
        r = self.contexts.successor(context)
        if r == self.contexts.n or self.contexts.select(r) != context:
            return None
        end = self.pointers.select(r + 1)
        at = self.successors.successor(r << self.bits | successor, self.pointers.select(r), end)
        if at == end or self.successors.select(at) != r << self.bits | successor:
            return None
        return float(self.book[self.codes[at]])

    @cached_property
    def _lists(self) -> tuple[np.ndarray, np.ndarray]:
        """Contexts and successors, decoded once for all bulk queries."""
        return self.contexts.all().astype(np.int64), self.successors.all().astype(np.int64)

    def log_ps(self, keys: np.ndarray) -> np.ndarray:
        """Of many pairs; NaN where a pair is not kept."""
        out = np.full(len(keys), np.nan)
        contexts, successors = self._lists
        if not len(successors):
            return out
        r = np.searchsorted(contexts, keys >> self.bits)
        known = r < len(contexts)
        known[known] = contexts[r[known]] == (keys >> self.bits)[known]
        want = r.astype(np.int64) << self.bits | keys & (1 << self.bits) - 1
        at = np.minimum(np.searchsorted(successors, want), len(successors) - 1)
        known &= successors[at] == want
        out[known] = self.book[self.codes[at[known]]]
        return out


class HashTrie:
    """A shard of pairs with a word outside the head: its words as one ascending list of hashes, and a trie over their places.

    The values are log10 ratios of a pair's probability to that by backoff.
    """

    def __init__(self, data):
        words, at = EliasFano.from_buffer(data)
        self.words, self.trie = words.all(), Trie(data, at, 32)

    @staticmethod
    def build(a: np.ndarray, b: np.ndarray, ratio: np.ndarray) -> bytes:
        words, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        keys = place[: len(a)].astype(np.int64) << 32 | place[len(a) :]
        order = np.argsort(keys)
        return EliasFano.build(words).to_bytes() + Trie.build(keys[order], ratio[order], 32)

    def ratios(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of many pairs; NaN where a pair is not kept."""
        out = np.full(len(a), np.nan)
        at = [np.minimum(np.searchsorted(self.words, h), len(self.words) - 1) for h in (a, b)]
        known = (self.words[at[0]] == a) & (self.words[at[1]] == b)
        out[known] = self.trie.log_ps(at[0][known].astype(np.int64) << 32 | at[1][known])
        return out


class Lexicon:
    """The trie's first level: head words by hash, with ids, log10 unigram probabilities and log10 backoff weights."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, end: int, tokens: int, types: int):
        """`hashes` in order of id from 1; id 0 is the end."""
        order = np.argsort(hashes)
        self.sorted, self.ids = hashes[order], (order + 1).astype(np.int64)
        self.counts = np.concatenate([[end], counts]).astype(float)
        self.total, self.types = tokens + end, types + (end > 0)
        self.log_total = np.log10(self.total + ADD * (self.types + 1))
        self.log_p1 = np.log10(self.counts + ADD) - self.log_total
        self.log_backoff = np.zeros(len(self.counts))

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Ids of hashes, -1 outside the head."""
        if not len(self.sorted):
            return np.full(len(h), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        return np.where(self.sorted[at] == h, self.ids[at], -1)

    def coded(self, texts: pa.Array) -> Coded:
        """Every token of a block, ends included."""
        words, code, own = tokens_of(texts)
        h = word_hashes(words)
        order = np.argsort(h)
        hashes, rank_of = np.append(np.uint64(0), h[order]), np.empty(len(h), dtype=np.int32)
        rank_of[order] = np.arange(1, len(h) + 1)
        id_of = self.lookup(hashes)
        sizes = np.bincount(own, minlength=len(texts))
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes + 1)
        is_end = np.zeros(len(doc), dtype=bool)
        is_end[np.cumsum(sizes + 1) - 1] = True
        rank = np.zeros(len(doc), dtype=np.int32)
        rank[~is_end] = rank_of[code]
        return Coded(np.where(is_end, END, id_of[rank]), rank, hashes, doc, is_end)


class Coded(NamedTuple):
    """The tokens of a block: head id or -1, place of the hash in `hashes` (ascending; the end has hash 0), document, is end."""

    ids: np.ndarray
    rank: np.ndarray
    hashes: np.ndarray
    doc: np.ndarray
    is_end: np.ndarray


def pairs(ids: np.ndarray, is_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pair keys of neighbours in one text that both are in the head, and the positions of their contexts."""
    at = np.flatnonzero(~is_end[:-1] & (ids[:-1] >= 0) & (ids[1:] >= 0)) if len(ids) else np.zeros(0, np.int64)
    return ids[at] << 16 | ids[at + 1], at


def rare_pairs(coded: Coded, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs, by hashes, of neighbours in one text of which one is outside the head, with document and number of
    occurrences. With `docs` 1, of the whole block.

    Places and document go into one key of 64 bits: a block has few documents or, with a longer text, one.
    """
    ids, words = coded.ids, np.uint64(len(coded.hashes))
    at = np.flatnonzero(~coded.is_end[:-1] & ((ids[:-1] < 0) | (ids[1:] < 0))) if len(ids) else np.zeros(0, np.int64)
    key = coded.rank[at].astype(np.uint64) * words + coded.rank[at + 1].astype(np.uint64)
    if docs > 1:
        key = key * np.uint64(docs) + coded.doc[at].astype(np.uint64)
    key, n = np.unique(key, return_counts=True)
    key, doc = np.divmod(key, np.uint64(docs))
    a, b = np.divmod(key, words)
    return coded.hashes[a], coded.hashes[b], doc, n


def distinct(*keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct tuples of some columns, ascending, and how often each occurs, or the sums of weights."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    which = np.cumsum(new) - 1
    n = np.bincount(which, weights=None if weights is None else weights[order]).astype(np.int64)
    return [k[new] for k in keys], n


def bucket_of_rare(a: np.ndarray, b: np.ndarray, buckets: int) -> np.ndarray:
    """By context and four bits of the successor."""
    return bucket_of_word((a ^ (b & np.uint64(15))) * np.uint64(0x9E3779B97F4A7C15), buckets).astype(np.int64)


def count_words(train: DataFrame, buckets: int, head: int) -> DataFrame:
    """Exact counts of all training words: a row for each bucket of hashes, ascending, with its share of the head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in blocks(batches):
            words, code, _ = tokens_of(texts)
            n = np.bincount(code, minlength=len(words)).astype("<u4")
            if n.any():
                h, n = word_hashes(words)[n > 0], n[n > 0]
                yield packed(dealt(bucket_of_word(h, buckets).astype(np.int64), 0, 0, h, n, np.zeros((len(h), 0), np.uint8)))

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        h = np.frombuffer(b"".join(pdf["a"]), np.uint64)
        n = np.frombuffer(b"".join(pdf["b"]), "<u4")
        h, which = np.unique(h, return_inverse=True)
        n = np.bincount(which, weights=n).astype(np.int64)
        top = np.lexsort([h, -n])[:share]
        row = [int(pdf["bucket"].iloc[0]), h.tobytes(), n.tobytes(), len(h), int(n.sum()), h[top].tobytes(), n[top].tobytes()]
        return pd.DataFrame([row], columns=["bucket", "h", "n", "types", "tokens", "top_h", "top_n"])

    share = -(-(head - 1) // buckets)
    schema = "bucket int, h binary, n binary, types long, tokens long, top_h binary, top_n binary"
    return materialise(train.mapInArrow(run, PACK).groupBy("bucket").applyInPandas(add, schema))


def read_lexicon(vocabulary: DataFrame, end: int, head: int) -> Lexicon:
    rows = vocabulary.select("types", "tokens", "top_h", "top_n").collect()
    h = np.frombuffer(b"".join(bytes(r["top_h"]) for r in rows), np.uint64)
    n = np.frombuffer(b"".join(bytes(r["top_n"]) for r in rows), np.int64)
    order = np.lexsort([h, -n])[: head - 1]
    return Lexicon(h[order], n[order], end, sum(r["tokens"] for r in rows), sum(r["types"] for r in rows))


def count_pairs(train: DataFrame, lexicon: Lexicon, buckets: int) -> DataFrame:
    """Pairs kept, by bucket: ascending keys with counts, and for each context the discounted sum of its kept pairs; of the
    pairs with a word outside the head, hashes `a` and `b` and counts `m`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in blocks(batches):
            coded = lexicon.coded(texts)
            rows = []
            key, n = np.unique(pairs(coded.ids, coded.is_end)[0], return_counts=True)
            if len(key):
                a = key.astype("<u4")
                rows += dealt(bucket_of_pair(a, buckets).astype(np.int64), 0, 0, a, n.astype("<u4"), np.zeros((len(a), 0), np.uint8))
            a, b, _, n = rare_pairs(coded, 1)
            if len(a):
                rows += dealt(bucket_of_rare(a, b, buckets), 1, 0, a, b, n.astype("<u4"))
            if rows:
                yield packed(rows)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        head, rare = pdf[pdf["kind"] == 0], pdf[pdf["kind"] == 1]
        key, which = np.unique(np.frombuffer(b"".join(head["a"]), "<u4"), return_inverse=True)
        n = np.bincount(which, weights=np.frombuffer(b"".join(head["b"]), "<u4")).astype(np.int64)
        key, n = key[n >= LEAST], n[n >= LEAST]
        context, which = np.unique(key >> 16, return_inverse=True)
        kept = np.bincount(which, weights=n - DISCOUNT, minlength=len(context))
        a, b, m = (np.frombuffer(b"".join(rare[c]), t) for c, t in zip("abc", (np.uint64, np.uint64, "<u4"), strict=True))
        (a, b), m = distinct(a, b, weights=m)
        often = m >= LEAST
        row = [int(pdf["bucket"].iloc[0]), key.tobytes(), n.tobytes(), context.astype("<u4").tobytes(), kept.tobytes()]
        row += [x[often].tobytes() for x in (a, b, m)]
        return pd.DataFrame([row], columns=["bucket", "keys", "n", "contexts", "kept", "a", "b", "m"])

    schema = "bucket int, keys binary, n binary, contexts binary, kept binary, a binary, b binary, m binary"
    return materialise(train.mapInArrow(run, PACK).groupBy("bucket").applyInPandas(add, schema))


def rare_rows(counted: DataFrame) -> DataFrame:
    """The kept pairs with a word outside the head, a row each: the hashes a and b and the count."""

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for own in zip(pdf["a"], pdf["b"], pdf["m"], strict=True):
                yield pd.DataFrame(dict(zip("abn", (np.frombuffer(x, np.int64) for x in own), strict=True)))

    return counted.select("a", "b", "m").mapInPandas(unpack, "a long, b long, n long")


def rare_mass(rare: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word, count) of the training words seen often enough for a pair, and (a, mass, count) of each context of `rare`."""

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for h, n in zip(pdf["h"], pdf["n"], strict=True):
                h, n = np.frombuffer(h, np.int64), np.frombuffer(n, np.int64)
                yield pd.DataFrame({"word": h[n >= LEAST], "count": n[n >= LEAST]})

    words = vocabulary.select("h", "n").mapInPandas(unpack, "word long, count long")
    mass = rare.groupBy("a").agg(F.sum(F.col("n") - DISCOUNT).alias("mass")).join(words.withColumnRenamed("word", "a"), "a")
    return words, materialise(mass)


def store_rare(rare: DataFrame, words: DataFrame, mass: DataFrame, lexicon: Lexicon, end: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(bucket, rare): the shards of the pairs; (bucket, contexts, backoffs): weights of the contexts outside the head."""
    counts = words.union(words.sparkSession.range(1).selectExpr("0L as word", f"{end}L as count"))

    def weigh(a: np.ndarray, mass: np.ndarray, count: np.ndarray) -> np.ndarray:
        at = lexicon.lookup(a)
        return np.where(at >= 0, lexicon.log_backoff[at], np.log10(np.maximum(1 - mass / count, 1e-12)))

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf["a"].to_numpy().view(np.uint64), pdf["b"].to_numpy().view(np.uint64)
        backoff = weigh(a, pdf["mass"].to_numpy(), pdf["count"].to_numpy())
        log_p1 = np.log10(pdf["other"].to_numpy() + ADD) - lexicon.log_total
        p = (pdf["n"].to_numpy() - DISCOUNT) / pdf["count"].to_numpy() + 10 ** (backoff + log_p1)
        return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "rare": [HashTrie.build(a, b, np.log10(p) - backoff - log_p1)]})

    def listed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("u")
        a = pdf["a"].to_numpy().view(np.uint64)
        row = [int(pdf["bucket"].iloc[0]), a.tobytes(), weigh(a, pdf["mass"].to_numpy(), pdf["count"].to_numpy()).tobytes()]
        return pd.DataFrame([row], columns=["bucket", "contexts", "backoffs"])

    def numbered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            a, b = pdf["a"].to_numpy().view(np.uint64), pdf["b"].to_numpy().view(np.uint64)
            yield pdf.assign(bucket=bucket_of_rare(a, b, buckets).astype(np.int32))

    def outside(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            a = pdf["a"].to_numpy().view(np.uint64)
            pdf = pdf.assign(bucket=bucket_of_word(a, buckets).astype(np.int32), u=(a >> np.uint64(1)).astype(np.int64))
            yield pdf[lexicon.lookup(a) < 0]

    full = rare.join(mass, "a").join(counts.withColumnsRenamed({"word": "b", "count": "other"}), "b").select("a", "b", "n", "mass", "count", "other")
    full = full.mapInPandas(numbered, "a long, b long, n long, mass double, count long, other long, bucket int")
    contexts = mass.select("a", "mass", "count").mapInPandas(outside, "a long, mass double, count long, bucket int, u long")
    return (
        materialise(full.groupBy("bucket").applyInPandas(shard, "bucket int, rare binary")),
        materialise(contexts.groupBy("bucket").applyInPandas(listed, "bucket int, contexts binary, backoffs binary")),
    )


def set_backoff(lexicon: Lexicon, counted: DataFrame, mass: DataFrame) -> None:
    """Backoff weights from the kept mass. To the driver come at most 17 entries for each head word."""
    kept = np.zeros(len(lexicon.counts))
    for r in counted.select("contexts", "kept").toLocalIterator():
        np.add.at(kept, np.frombuffer(bytes(r["contexts"]), "<u4"), np.frombuffer(bytes(r["kept"]), float))

    def inside(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            at = lexicon.lookup(pdf["a"].to_numpy().view(np.uint64))
            yield pd.DataFrame({"id": at[at >= 0], "mass": pdf["mass"].to_numpy()[at >= 0]})

    for r in mass.select("a", "mass").mapInPandas(inside, "id long, mass double").toLocalIterator():
        kept[r["id"]] += r["mass"]
    left = 1 - kept / np.maximum(lexicon.counts, 1)
    lexicon.log_backoff = np.log10(np.maximum(left, 1e-12))


def build_tries(counted: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(bucket, trie) of every bucket with kept pairs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for bucket, keys, n in zip(pdf["bucket"], pdf["keys"], pdf["n"], strict=True):
                key, n = np.frombuffer(keys, "<u4").astype(np.int64), np.frombuffer(n, np.int64)
                a, b = key >> 16, key & 0xFFFF
                p = (n - DISCOUNT) / lexicon.counts[a] + 10 ** (lexicon.log_backoff[a] + lexicon.log_p1[b])
                out.append((bucket, Trie.build(key, np.log10(p))))
            yield pd.DataFrame(out, columns=["bucket", "trie"])

    return materialise(counted.select("bucket", "keys", "n").mapInPandas(run, "bucket int, trie binary"))


def ask(docs: DataFrame, lexicon: Lexicon, buckets: int) -> DataFrame:
    """Packed questions of all documents: kind 0 words outside the head, 1 pairs of the head, 2 what a block knows by itself,
    3 other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for doc_ids, held, texts in blocks(batches):
            block, number = TaskContext.get().partitionId() << 32 | number, number + 1
            coded, n = lexicon.coded(texts), len(texts)
            ids, doc, is_end = coded.ids, coded.doc, coded.is_end
            in_head = ids >= 0
            base = np.bincount(doc[in_head], weights=lexicon.log_p1[ids[in_head]], minlength=n)
            known = np.bincount(doc[in_head], weights=lexicon.counts[ids[in_head]] > 0, minlength=n)
            context = in_head & ~is_end
            backoff = np.bincount(doc[context], weights=lexicon.log_backoff[ids[context]], minlength=n)
            own = pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64"), "held": held})
            head = [np.array([d is None for d in doc_ids]), np.array([d or 0 for d in doc_ids], np.int64), np.array(own["held"], bool)]
            tokens = np.bincount(doc, minlength=n).astype(np.int64)
            rows = [(block % buckets, 2, block, b"".join(x.tobytes() for x in head), b"".join(x.tobytes() for x in (base, known, backoff)), tokens.tobytes())]
            rare = ~in_head
            if rare.any():
                key, tf = np.unique(coded.rank[rare].astype(np.int64) << 16 | doc[rare], return_counts=True)
                a = coded.hashes[key >> 16]
                rows += dealt(bucket_of_word(a, buckets).astype(np.int64), 0, block, a, (key & 0xFFFF).astype("<u2"), tf.astype("<u4"))
            key, at = pairs(ids, is_end)
            if len(key):
                key, tf = np.unique(key.astype(np.uint64) << np.uint64(16) | doc[at].astype(np.uint64), return_counts=True)
                a = (key >> np.uint64(16)).astype("<u4")
                rows += dealt(bucket_of_pair(a, buckets).astype(np.int64), 1, block, a, (key & np.uint64(0xFFFF)).astype("<u2"), tf.astype("<u4"))
            a, b, own_doc, tf = rare_pairs(coded, n)
            if len(a):
                rows += dealt(bucket_of_rare(a, b, buckets), 3, block, np.stack([a, b], axis=1), own_doc.astype("<u2"), tf.astype("<u4"))
            yield packed(rows)

    return docs.mapInArrow(run, PACK)


def by_document(doc: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The documents of a block that occur in `doc`, ascending, and the sums of each column of values for them."""
    docs = np.flatnonzero(np.bincount(doc))
    return docs, [np.bincount(doc, weights=v)[docs] for v in values]


def answer(questions: DataFrame, store: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per block and bucket, the sums for each document; a block's own row passes through."""

    def run(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        h, n, trie, rare = np.zeros(0, np.uint64), np.zeros(0, np.int64), None, None
        contexts, backoffs = np.zeros(0, np.uint64), np.zeros(0)
        for words, counts, data, more, outside, weights in zip(*(held[c] for c in STORE), strict=True):
            if words is not None:
                h, n = np.frombuffer(words, np.uint64), np.frombuffer(counts, np.int64)
            if data is not None:
                trie = Trie(data)
            if more is not None:
                rare = HashTrie(more)
            if outside is not None:
                contexts, backoffs = np.frombuffer(outside, np.uint64), np.frombuffer(weights, float)
        out = []
        for kind, block, a, b, c in zip(asked["kind"], asked["block"], asked["a"], asked["b"], asked["c"], strict=True):
            if kind == 2:
                out.append((block, 2, a, b, c, b""))
                continue
            doc, tf = np.frombuffer(b, "<u2"), np.frombuffer(c, "<u4")
            if kind == 0:
                a = np.frombuffer(a, np.uint64)
                at = np.minimum(np.searchsorted(h, a), max(0, len(h) - 1))
                count = np.where(h[at] == a, n[at], 0) if len(h) else np.zeros(len(a), np.int64)
                base, known = tf * (np.log10(count + ADD) - lexicon.log_total), tf * (count > 0)
                # Words outside the head are never the end, so all their occurrences are contexts.
                at = np.minimum(np.searchsorted(contexts, a), max(0, len(contexts) - 1))
                model = tf * np.where(contexts[at] == a, backoffs[at], 0.0) if len(contexts) else np.zeros(len(a))
                docs, sums = by_document(doc, base, known, model)
            elif kind == 3:
                if rare is None:
                    continue
                more = tf * rare.ratios(*np.frombuffer(a, np.uint64).reshape(-1, 2).T)
                seen = ~np.isnan(more)
                docs, (more,) = by_document(doc[seen], more[seen])
                sums = [np.zeros(len(docs)), np.zeros(len(docs)), more]
            elif trie is not None:
                key = np.frombuffer(a, "<u4").astype(np.int64)
                log_p = trie.log_ps(key)
                seen = ~np.isnan(log_p)
                more = tf[seen] * (log_p[seen] - lexicon.log_backoff[key[seen] >> 16] - lexicon.log_p1[key[seen] & 0xFFFF])
                docs, (more,) = by_document(doc[seen], more)
                sums = [np.zeros(len(docs)), np.zeros(len(docs)), more]
            else:
                continue
            out.append((block, kind, docs.astype("<u2").tobytes(), *(x.tobytes() for x in sums)))
        return pd.DataFrame(out, columns=["block", "kind", "docs", "base", "known", "model"])

    return questions.groupBy("bucket").cogroup(store.groupBy("bucket")).applyInPandas(run, ANSWER)


def collect_block(pdf: pd.DataFrame) -> pd.DataFrame:
    own = pdf[pdf["kind"] == 2].iloc[0]
    tokens = np.frombuffer(own["known"], np.int64)
    n = len(tokens)
    null = np.frombuffer(own["docs"], bool, n)
    doc_id, held = np.frombuffer(own["docs"], np.int64, n, n), np.frombuffer(own["docs"], bool, n, 9 * n)
    base, known, model = np.frombuffer(own["base"], float).reshape(3, n).copy()
    for r in pdf[pdf["kind"] != 2].itertuples():
        doc = np.frombuffer(r.docs, "<u2")
        for total, part in ((base, r.base), (known, r.known), (model, r.model)):
            total[doc] += np.frombuffer(part, float)
    ids = pd.array(doc_id, "Int64")
    ids[null] = pd.NA
    columns = [ids, held, tokens, np.round(known).astype(np.int64), base, base + model]
    return pd.DataFrame(dict(zip(["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"], columns, strict=True)))


def scores(docs: DataFrame, folds: int = 10, head: int = HEAD) -> DataFrame:
    """Scores of every row of `docs` from a model trained on those whose crc32 of the id modulo `folds` is not 0.

    Null and empty texts are the end token alone; null ids count as empty text in the fold; repeated rows count and are
    scored each; empty input gives no rows; without training documents every known count is 0. Other columns are not
    looked at. Buckets are as many as the session's shuffle partitions; a bucket holds its share of the words and pairs.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = label_hash(docs["doc_id"], folds) == 0
    three = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held.alias("held"), docs["text"].cast("string").alias("text"))
    train = three.where("not held")
    vocabulary = count_words(train, buckets, head)
    end = train.count()
    lexicon = read_lexicon(vocabulary, end, head)
    counted = count_pairs(train, lexicon, buckets)
    rare = rare_rows(counted)
    words, mass = rare_mass(rare, vocabulary)
    set_backoff(lexicon, counted, mass)
    parts = [vocabulary.select("bucket", "h", "n"), build_tries(counted, lexicon), *store_rare(rare, words, mass, lexicon, end, buckets)]
    none = F.lit(None).cast("binary")
    store = reduce(DataFrame.unionByName, [p.select("bucket", *[c if c in p.columns else none.alias(c) for c in STORE]) for p in parts])
    answers = answer(ask(three, lexicon, buckets), store, lexicon)
    result = answers.groupBy("block").applyInPandas(collect_block, RESULT)
    return result.withColumn("train_tokens", F.lit(int(lexicon.total)).cast("long"))
