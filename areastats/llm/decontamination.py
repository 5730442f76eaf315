"""Benchmark decontamination: every passage of the corpus against a BM25 index of the test items.

The index holds each item's BM25 weights as shares of the item's own full score, in postings cut into blocks with their
largest weight. A passage is a window of twice the longest item, moved by its length, so an item that occurs lies wholly
in one window. Frequent terms that make up a quarter of any item's score at most are light; windows whose other terms
leave every item short of the threshold by more than its light terms add are dropped in bulk. The others run
block-max WAND: cursors sorted by item, a pivot from the terms' largest weights, then the blocks' largest weights, and
blocks that cannot reach the threshold are leapt over. All items at or above the threshold are verified: word shingles of
the question and of the answer must be in the passage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import materialise

END = 1 << 60
#: The most that the light terms of an item may add to its score.
LIGHT = 0.25
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¡¿«»“”„‘’…–—"


def words_in(text: str | None) -> list[str]:
    return (text or "").lower().split()


def tokens(text: str | None) -> list[str]:
    """Lower-case words without the punctuation around them; words of punctuation only are none."""
    return [w for w in (w.strip(EDGES) for w in words_in(text)) if w]


class TermIds(dict):
    """Term of a word as it stands in a text, -1 if the index has none; remembers the words it has met."""

    def __init__(self, terms: dict[str, int], most: int = 500_000):
        super().__init__()
        self.terms, self.most = terms, most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = self.terms.get(word.strip(EDGES), -1)
        return found


@dataclass
class Statistics:
    """What BM25 needs of all items: how many have words, the longest and the mean length, and the items of each term."""

    items: int
    longest: int
    mean: float
    df: dict[str, int]

    @classmethod
    def of(cls, items: list[list[str]]) -> Statistics:
        sizes = [len(w) for w in items]
        return cls(len(items), max(sizes, default=1), sum(sizes) / max(1, len(sizes)), Counter(t for w in items for t in set(w)))


class Index:
    """BM25 postings of test items with block maxima. Weights are shares of an item's own score, so 1 is a full match.

    Term weights, mean length and window length are those of the whole benchmark (`stats`), of which the items may be a
    part; without `stats` the items are all there is.
    """

    def __init__(
        self, items: list[tuple[int, str | None]], stats: Statistics | None = None, k1: float = 1.2, b: float = 0.75, block: int = 8
    ):
        self.items = [(i, w) for i, w in ((i, tokens(t)) for i, t in sorted(items, key=lambda x: (x[0], x[1] or ""))) if w]
        n, stats = len(self.items), stats or Statistics.of([w for _, w in self.items])
        self.longest, mean, df = stats.longest, stats.mean, stats.df
        own_terms = sorted({t for _, w in self.items for t in w})
        self.terms = {t: k for k, t in enumerate(own_terms)}
        idf = {t: log(1 + (stats.items - df[t] + 0.5) / (df[t] + 0.5)) for t in own_terms}
        self.lists: list[list[int]] = [[] for _ in own_terms]
        self.weights: list[list[float]] = [[] for _ in own_terms]
        for at, (_, words) in enumerate(self.items):
            norm = k1 * (1 - b + b * len(words) / mean)
            own = {t: idf[t] * c * (k1 + 1) / (c + norm) for t, c in Counter(words).items()}
            total = sum(own.values())
            for t, x in own.items():
                self.lists[self.terms[t]].append(at)
                self.weights[self.terms[t]].append(x / total)
        self.block = block
        self.block_max = [[max(w[i : i + block]) for i in range(0, len(w), block)] for w in self.weights]
        self.most = np.array([max(w) for w in self.weights], dtype=float)
        light, heavy = np.zeros(n), np.ones(len(own_terms), dtype=bool)
        for t in sorted(range(len(own_terms)), key=lambda t: (-len(self.lists[t]), t)):
            own = np.array(self.lists[t])
            if (light[own] + self.weights[t]).max() <= LIGHT:
                light[own] += self.weights[t]
                heavy[t] = False
        self.light, self.heavy = light, heavy
        self.size = np.array([len(x) for x in self.lists], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat_items = np.array([i for x in self.lists for i in x], dtype=np.int64)
        self.flat_weights = np.array([x for w in self.weights for x in w], dtype=float)

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All (item position, score) with score at or above the threshold, for a set of terms: block-max WAND."""
        out, size, slack = [], self.block, threshold - 1e-9
        cursors = [[self.lists[t][0], 0, t] for t in terms]  # item, position, term
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for i, (_, _, t) in enumerate(cursors):
                bound += self.most[t]
                if bound >= slack:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            bound, leap = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else END
            for _, at, t in cursors[: pivot + 1]:
                at = bisect_left(self.lists[t], item, at)
                if at < len(self.lists[t]):
                    b = at // size
                    bound += self.block_max[t][b]
                    leap = min(leap, self.lists[t][min((b + 1) * size, len(self.lists[t])) - 1] + 1)
            if bound < slack:
                target = max(leap, item + 1)  # nothing before it can reach the threshold
            elif cursors[0][0] == item:
                score = sum(self.weights[t][at] for _, at, t in cursors[: pivot + 1])
                if score >= slack:
                    out.append((item, score))
                target = item + 1
            else:
                target = item
            for c in cursors[: pivot + 1]:
                if c[0] < target:
                    c[1] = bisect_left(self.lists[c[2]], target, c[1])
                    c[0] = self.lists[c[2]][c[1]] if c[1] < len(self.lists[c[2]]) else END
            cursors = [c for c in cursors if c[0] < END]
        return out

    def parts(self, at: int) -> tuple[list[str], list[str]]:
        """Question and answer of an item: the answer is its last third, five words at least; short items are both."""
        words = self.items[at][1]
        cut = len(words) - max(5, len(words) // 3)
        return (words[:cut], words[cut:]) if cut >= 5 else (words, words)


def overlap(part: list[str], passage: list[str], width: int = 5) -> float:
    """Share of the part's word shingles that the passage has."""
    width = min(width, len(part))
    have = {tuple(passage[i : i + width]) for i in range(len(passage) - width + 1)}
    want = {tuple(part[i : i + width]) for i in range(len(part) - width + 1)}
    return len(want & have) / len(want)


def hot_windows(window: np.ndarray, term: np.ndarray, index: Index, threshold: float) -> list[int]:
    """Windows in which some item's heavy terms come as near to the threshold as its light terms can make up for.

    `window` and `term` are distinct pairs of heavy terms. Each meets only its own postings.
    """
    size = index.size[term]
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(index.start[term], size)
    n = len(index.items)
    key, which = np.unique(np.repeat(window, size) * n + index.flat_items[at], return_inverse=True)
    score = np.bincount(which, weights=index.flat_weights[at], minlength=len(key))
    return np.unique(key[score >= threshold - index.light[key % n] - 1e-9] // n).tolist()


def find(texts: list[str | None], index: Index, ids: TermIds, threshold: float, similarity: float) -> list[tuple]:
    """(row, item id, score, question overlap, answer overlap) of each item found, once per row with its best score."""
    if not index.items:
        return []
    words = [words_in(t) for t in texts]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    step = index.longest
    cells = sizes // step + 2  # one empty cell at least parts two texts
    first = np.cumsum(cells) - cells
    term = np.fromiter(map(ids.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=int(sizes.sum()))
    at = np.flatnonzero(term >= 0)
    at = at[index.heavy[term[at]]]
    start = np.cumsum(sizes) - sizes
    row = np.searchsorted(start, at, side="right") - 1
    cell = first[row] + (at - start[row]) // step
    n = len(index.terms)
    # A word lies in the window that starts with its own cell and in the one before.
    key = np.unique(np.concatenate([cell * n + term[at], (cell - 1) * n + term[at]]))
    key = key[key >= 0]
    best: dict[tuple[int, int], tuple] = {}
    for k in hot_windows(key // n, key % n, index, threshold):
        r = max(0, int(np.searchsorted(first, k, side="right")) - 1)
        begin = max(0, k - int(first[r])) * step
        own = term[start[r] + begin : start[r] + min(begin + 2 * step, sizes[r])]
        found = index.search(np.unique(own[own >= 0]).tolist(), threshold)
        passage = tokens(" ".join(words[r][begin : begin + 2 * step])) if found else []
        for i, score in found:
            question, answer = (overlap(part, passage) for part in index.parts(i))
            if question >= similarity and answer >= similarity and score > best.get((r, i), (0, 0, 0.0))[2]:
                best[r, i] = (r, index.items[i][0], score, question, answer)
    return [best[k] for k in sorted(best)]


def cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item_id, text, number of words and distinct terms of the items that have words."""
    for batch in batches:
        found = [(i, t, tokens(t)) for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        rows = [(i, t, len(w), sorted(set(w))) for i, t, w in found if w]
        if rows:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string())]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "text", "words", "terms"])


def blocks(benchmark: DataFrame, items_per_block: int) -> Iterator[Index]:
    """The items in blocks of a bounded number, each of which comes to the driver and goes to the tasks as one index.

    Counts of terms and lengths are taken over all items, so an item's scores do not depend on the blocks.
    """
    two = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text"))
    cut = two.where("item_id is not null").mapInArrow(cut_items, "item_id long, text string, words long, terms array<string>")
    cut = materialise(cut)
    n, longest, mean = cut.agg(F.count(F.lit(1)), F.max("words"), F.avg("words")).first()
    count = max(1, -(-n // items_per_block))
    terms = cut.select("item_id", "text", F.explode("terms").alias("term"))
    df = materialise(terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        own = cut.where(part == k)
        known = df if count == 1 else df.join(terms.where(part == k).select("term").distinct(), "term")
        stats = Statistics(n, longest or 1, mean or 0.0, {r["term"]: r["n"] for r in known.select("term", "n").collect()})
        yield Index([(r["item_id"], r["text"]) for r in own.select("item_id", "text").collect()], stats)


def leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, similarity: float = 0.8, items_per_block: int = 20_000
) -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id, score, question_overlap, answer_overlap.

    Null and empty texts hold nothing; long texts are searched window by window, whole; items without words or id are never
    found; items of equal text are each found; an item that repeats is found once; repeated rows are each searched; of windows
    that tie the first counts; empty tables give no rows. Other columns are not looked at.
    """
    two = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    out = None
    for index in blocks(benchmark, items_per_block):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            terms = TermIds(index.terms)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for at in range(0, len(ids), 1024):
                    rows = find(batch.column(1).slice(at, 1024).to_pylist(), index, terms, threshold, similarity)
                    if rows:
                        columns = list(zip(*[(ids[at + r], *more) for r, *more in rows], strict=True))
                        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                        names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
                        arrays = [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]
                        yield pa.RecordBatch.from_arrays(arrays, names=names)

        found = two.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, similarity: float = 0.8, items_per_block: int = 20_000
) -> DataFrame:
    """The rows of `docs` without any test item, with their columns, in one pass for each block of items.

    Null, empty and long texts, repeated rows and empty tables as in `leaks`; rows without text stay.
    """
    for index in blocks(benchmark, items_per_block):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            terms = TermIds(index.terms)
            for batch in batches:
                texts, keep = batch.column(batch.schema.get_field_index("text")), np.ones(batch.num_rows, dtype=bool)
                for at in range(0, batch.num_rows, 1024):
                    for r, *_ in find(texts.slice(at, 1024).to_pylist(), index, terms, threshold, similarity):
                        keep[at + r] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
