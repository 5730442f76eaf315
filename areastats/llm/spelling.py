"""Spelling variants by asymmetric q-chunks.

Of two words one edit apart, the one that is shorter (or, at equal length, first in order) contributes chunks and the other
positional grams. The first is cut into two disjoint chunks, its halves. The edit breaks one of them at most, so the other
stands in the second word: before the edit at its own place, behind it shifted by the difference in length, which is none
or one. The words that share a half grow with the square of the vocabulary, so the same law is used once more inside the
broken half: its own two chunks, of which again one survives. That gives four quarters, of which three survive, and a key
for each quarter that may be broken. Grams further than one place from a chunk's place can never meet it and are not made.
The join on (length, quarter, surviving text) yields candidates, and the edit distance decides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import materialise

#: Letters A-Z, a-z and U+00C0 to U+00FF as UTF-8, after A-Z became a-z.
RUNS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
QUARTERS = 4


def code_points(word: bytes) -> int:
    return len(word) - word.count(b"\xc3")


def less_one(word: bytes, at: int) -> bytes:
    text = word.decode()
    return (text[:at] + text[at + 1 :]).encode()


def word_counts(docs: DataFrame, least: int = 6, rate: int = 199, most: int = 300_000) -> DataFrame:
    """(word, n) of the words of at least `least` code points in all texts.

    A run whose crc32 with its document's id is a multiple of `rate` loses one code point. Tasks count before the shuffle;
    a task's table is passed on when it holds `most` words, so its memory is bounded and nothing is lost.
    """

    def passed(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for d, t in zip(batch.column(0).to_pylist(), texts, strict=True):
                start = zlib.crc32(b":" if d is None else b"%d:" % d)
                for word, n in Counter(RUNS.findall((t.as_py() or b"").lower())).items():
                    h = zlib.crc32(word, start)
                    if h % rate == 0:
                        word = less_one(word, h % code_points(word))
                    if code_points(word) >= least:
                        counts[word] += n
                if len(counts) >= most:
                    yield passed(counts)
                    counts = Counter()
        if counts:
            yield passed(counts)

    two = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return two.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def cuts(length: str) -> list[str]:
    """Where the quarters of a word of `length` code points start and end, from 0, as SQL."""
    half = f"({length} div 2)"
    return ["0", f"({half} div 2)", half, f"({half} + ({length} - {half}) div 2)", length]


def keys(word: str, length: str, shift: int) -> Column:
    """A key for each quarter: what stands when only that quarter is broken, in a word longer by `shift` than `length`."""
    at = cuts(length)
    rows = [
        f"struct({e} as part, concat(left({word}, {at[e]}), substr({word}, {at[e + 1]} + {1 + shift})) as kept)"
        for e in range(QUARTERS)
    ]
    return F.expr(f"array({', '.join(rows)})")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) for all ordered pairs of distinct words one inserted, deleted or replaced code point apart.

    `words` holds distinct (word, n). A pair meets at several quarters only where letters repeat; it is taken at the one
    that holds its first difference, so nothing needs a distinct.
    """
    sized = words.select("word", "n", F.length("word").alias("size"))
    chunks = sized.select("word", "n", "size", F.inline(keys("word", "size", 0)))
    longer = sized.withColumn("size", F.col("size") - 1)
    grams = chunks.withColumn("shift", F.lit(0)).unionByName(
        longer.select("word", "n", "size", F.inline(keys("word", "size", 1)), F.lit(1).alias("shift"))
    )
    grams = grams.withColumnsRenamed({"word": "other", "n": "other_n"})
    met = chunks.join(grams, ["size", "part", "kept"]).where("shift = 1 or word < other")
    at = cuts("size")
    starts, ends = (f"element_at(array({', '.join(x)}), part + 1)" for x in (at[:-1], at[1:]))
    own, its = (f"substr({w}, {starts} + 1, {ends} - {starts})" for w in ("word", "other"))
    near = met.where(f"(part = {QUARTERS - 1} or {own} <> {its}) and levenshtein(word, other, 1) = 1")
    there = near.select("word", "n", "other", "other_n")
    return there.unionByName(near.select("other", "other_n", "word", "n").toDF(*there.columns))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every (word, form): the last of the chain. Counts grow along a chain, so there is no circle.

    Each round doubles the steps taken, so rounds grow with the logarithm of the longest chain.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        if now.join(step, F.col("root") == F.col("_at"), "left_semi").isEmpty():
            return now
        now = materialise(now.join(step, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root")))


def variants(docs: DataFrame, least: int = 6, often: int = 5, ratio: int = 5, rate: int = 199) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of at least `least` code points and `often` occurrences.

    A word's form is its near word with the most occurrences, the first in code-point order among equals, if it has
    `ratio` times the word's own or more. Null and empty texts have no words; a null id counts as empty text in the crc32;
    repeated rows count each; a text of any length is read whole; empty input gives no rows. Other columns are not looked
    at. A hot word is one row after the counts, and many words of one form are the split side of the joins.
    """
    words = materialise(word_counts(docs, least, rate).where(F.col("n") >= often))
    none = words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n"))
    best = F.struct((-F.col("other_n")).alias("order"), F.col("other").alias("form"))
    own = none.unionByName(near_pairs(words)).groupBy("word", "n").agg(
        F.count("other").alias("n_near"), F.min(F.when(F.col("other").isNotNull(), best)).alias("best")
    )
    strong = F.col("best").isNotNull() & (-F.col("best.order") >= ratio * F.col("n"))
    own = materialise(
        own.select("word", F.when(strong, F.col("best.form")).alias("form"), "n", "n_near", F.when(strong, -F.col("best.order")).alias("form_n"))
    )
    last = roots(own.where("form is not null")).withColumnRenamed("word", "_word")
    met = own.join(last, F.col("word") == F.col("_word"), "left")
    return met.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
