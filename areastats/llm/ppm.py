"""Language identification by prediction by partial matching.

Each language has a tree of the byte contexts of its training texts: contexts of up to `depth` - 1 bytes, each with the
bytes that followed it at least `least` times. A byte seen n times among the N of a context with D different bytes has the
probability n / (N + D); the escape probability D / (N + D) is spread over the other bytes as the next shorter context
gives them, down to equal shares of all 256, so the probabilities of every context sum to one and any text has an exact
code length. The statistics are frozen after training. A text's language is the one whose tree codes it in the fewest bits.

The trees of all languages share their nodes. A node is a run of bytes; `score[node]` is the log2 probability of its last
byte after the others less the escapes that its context has already paid, and `paid[node]` is the sum of the escapes of the
node and its suffixes. The longest known run that ends at a byte and the longest known context before it thus give the
byte's code length as one sum, and whole batches go through the trees a depth at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import label_hash, small_frame

ROOT, UNKNOWN = 0, 1
WINDOW = 1 << 20
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


def byte_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts as one array of bytes, and where each starts, with the end; null is empty."""
    folded = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    _, offsets, data = folded.buffers()
    starts = np.frombuffer(offsets, np.int64, len(folded) + 1, 8 * folded.offset)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def gram_keys(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Every run of `size` bytes inside one text as a number with a one before its bytes."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    key = np.ones(n, np.int64)
    for i in range(size):
        key = key << 8 | data[i : i + n]
    across = np.zeros(len(data) + 1, bool)
    bounds = starts[starts > 0]
    for i in range(1, size):
        across[np.maximum(bounds - i, 0)] = True
    return key[~across[:n]]


def gram_counts(train: DataFrame, depth: int) -> DataFrame:
    """(lang, gram, n) of all runs of 1 to `depth` bytes in the texts of `train`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            for lang in sorted(set(langs)):
                data, starts = byte_stream(batch.column(1).filter(pa.array(langs == lang)))
                for size in range(1, depth + 1):
                    key, n = np.unique(gram_keys(data, starts, size), return_counts=True)
                    columns = [pa.array([lang] * len(key), pa.string()), pa.array(key, pa.int64()), pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    return train.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Trees:
    """The frozen trees of all languages: runs of bytes by depth, ascending, and their numbers for each language."""

    langs: list[str]
    grams: list[np.ndarray]
    score: np.ndarray
    paid: np.ndarray

    @classmethod
    def grow(cls, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray, depth: int) -> Trees:
        """From counts: `lang` indexes `langs`, `gram` as of `gram_keys`."""
        wide = len(langs)
        grams, scores, paids = [], [], []
        lower_p, lower_paid = None, None
        for size in range(1, depth + 1):
            own = (gram >> 8 * size) == 1
            keys, row = np.unique(gram[own], return_inverse=True)
            count = np.zeros((len(keys), wide))
            count[row, lang[own]] = n[own]
            seen = count > 0
            if size == 1:
                contexts, context = 1, np.zeros(len(keys), np.int64)
                below = np.full((len(keys), wide), 1 / 256)
                paid_below = np.zeros((1, wide))
            else:
                low = (1 << 8 * (size - 1)) - 1
                contexts = len(grams[-1])
                context = np.searchsorted(grams[-1], keys >> 8)
                below = lower_p[np.searchsorted(grams[-1], (keys & low) | (low + 1))]
            total, kinds, covered = (np.zeros((contexts, wide)) for _ in range(3))
            for sums, x in ((total, count), (kinds, seen), (covered, seen * below)):
                np.add.at(sums, context, x)
            spread = np.where(kinds > 0, kinds / np.maximum(total + kinds, 1) / np.maximum(1 - covered, 1e-12), 1.0)
            if size > 1:  # a context pays its own escape after those of its suffixes
                paid_below = lower_paid
            paid = paid_below + np.log2(spread)
            p = np.where(seen, count / np.maximum(total + kinds, 1)[context], spread[context] * below)
            grams.append(keys)
            scores.append(np.log2(p) - paid[context])
            paids.append(paid)
            # The suffix of each run, as a context, has paid this much; the run's own escape is added at the next size.
            if size == 1:
                lower_paid = np.repeat(paid, len(keys), axis=0)
            else:
                suffix = np.searchsorted(grams[-2], (keys & low) | (low + 1))
                lower_paid = paid[suffix]
            lower_p = p
        none = np.zeros((1, wide))
        score = np.concatenate([none, none + np.log2(1 / 256), *scores])
        return cls(langs, grams, score.astype(np.float32), np.concatenate([paids[0], none, *paids[1:]]).astype(np.float32))


class Coder:
    """The trees with a table of children, for whole streams of bytes."""

    def __init__(self, trees: Trees):
        self.trees, self.depth = trees, len(trees.grams)
        self.symbol = np.zeros(256, np.int64)  # 0 for bytes that no training text has
        known = (trees.grams[0] & 255).astype(np.int64)
        self.symbol[known] = np.arange(1, len(known) + 1)
        self.width = len(known) + 1
        sizes = [len(g) for g in trees.grams]
        first = np.cumsum([2, *sizes])
        #: Runs of the greatest depth have no children, and nodes are in order of depth.
        self.inner = int(first[-2])
        child = np.full(self.inner * self.width, UNKNOWN, np.int32)
        child[self.symbol[known]] = first[0] + np.arange(sizes[0])
        for size in range(2, self.depth + 1):
            keys = trees.grams[size - 1]
            parent = first[size - 2] + np.searchsorted(trees.grams[size - 2], keys >> 8)
            child[parent * self.width + self.symbol[keys & 255]] = first[size - 1] + np.arange(len(keys))
        self.child = child

    def bits(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log2 probability of every text under every language, in windows of bounded size."""
        out = np.zeros((len(starts) - 1, len(self.trees.langs)))
        for a in range(0, len(data), WINDOW):
            self.window(data, starts, a, min(a + WINDOW, len(data)), out)
        return out

    def window(self, data: np.ndarray, starts: np.ndarray, a: int, b: int, out: np.ndarray) -> None:
        low = max(0, a - self.depth)
        symbol = self.symbol[data[low:b]]
        near = starts[np.searchsorted(starts, low - self.depth) : np.searchsorted(starts, b)]
        run = self.child[symbol]  # from the root
        longest = run
        context = longest
        for size in range(2, self.depth + 1):
            longer = np.full(len(symbol), UNKNOWN, np.int32)
            longer[1:] = self.child[run[:-1].astype(np.int64) * self.width + symbol[1:]]
            for back in range(size - 1):  # too near to the start of a text
                at = near + back - low
                longer[at[(at >= 0) & (at < len(symbol))]] = UNKNOWN
            run, context = longer, longest
            longest = np.where(longer == UNKNOWN, longest, longer)
        before = np.full(len(symbol), ROOT, np.int32)
        before[1:] = np.where(context[:-1] == UNKNOWN, ROOT, context[:-1])
        before[(near - low)[(near >= low) & (near < b)]] = ROOT
        value = self.trees.score[longest[a - low :]] + self.trees.paid[before[a - low :]]
        text = np.searchsorted(starts, a, side="right") - 1
        inside = starts[(starts > a) & (starts < b)]
        cuts = np.unique(np.concatenate([[a], inside]))
        owner = np.searchsorted(starts, cuts, side="right") - 1
        out[owner] += np.add.reduceat(value, cuts - a, axis=0, dtype=np.float64)


def train(docs: DataFrame, held: int, folds: int, max_bytes: int, depth: int, least: int) -> Trees | None:
    """Trees of every language of the rows outside the held-out fold; None if there is none.

    The bound of the fit: of each language whole texts of about `max_bytes` bytes in all, those with the smallest hashes of
    id and text; texts longer than a sixteenth of that are left out. What reaches the driver are the runs of those bytes,
    summed by Spark and seen `least` times or more.
    """
    spark = docs.sparkSession
    text = docs["text"].cast("string")
    rows = docs.where(docs["lang"].isNotNull() & (label_hash(docs["doc_id"], folds) != held) & (F.octet_length(text) <= max_bytes // 16))
    rows = rows.select(docs["lang"].cast("string").alias("lang"), text.alias("text"), F.xxhash64(docs["doc_id"], text).alias("h"))
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()
    shares = [{"_lang": r["lang"], "share": min(1.0, max_bytes / max(1, r["bytes"]))} for r in sizes]
    few = F.broadcast(small_frame(spark, shares, "_lang string, share double"))  # a row for each tree
    drawn = rows.join(few, F.col("lang") == F.col("_lang"))
    drawn = drawn.where(F.col("h") / F.lit(2.0**64) + 0.5 < F.col("share"))
    counts = gram_counts(drawn, depth).where((F.col("n") >= least) | (F.col("gram") < 1 << 16)).toArrow()
    if not counts.num_rows:
        return None
    langs, lang = np.unique(counts["lang"].to_numpy().astype(str), return_inverse=True)
    return Trees.grow(langs.tolist(), lang, counts["gram"].to_numpy(), counts["n"].to_numpy(), depth)


def predictions(docs: DataFrame, held: int = 0, folds: int = 5, max_bytes: int = 1 << 20, depth: int = 5, least: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of `docs`.

    Trained on the rows whose crc32 of the id modulo `folds` is not `held`; `lang`, source and id are no inputs of a
    prediction. The score is the share of the predicted language when all are weighted by the probability of the text;
    the first language in order wins ties. Null and empty texts and those without a letter are `und` with score 0, and so
    is every text when no row has a language. Whole texts are coded in windows, so a very long one takes no more memory;
    repeated rows are predicted each; null ids count as empty text in the fold; an empty table gives no rows; other columns
    are not looked at.
    """
    trees = train(docs, held, folds, max_bytes, depth, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(trees) if trees else None
        for batch in batches:
            texts = batch.column(2)
            letter = pc.match_substring_regex(texts, r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False)
            lang, score = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            if coder:
                total = coder.bits(*byte_stream(texts))
                best = total.argmax(axis=1)
                weight = np.exp2(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                lang = np.where(letter, np.array(trees.langs, dtype=object)[best], lang)
                score = np.where(letter, 1 / weight, 0.0)
            columns = [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in RESULT.split(", ")])

    three = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), (label_hash(docs["doc_id"], folds) == held).alias("held_out"), docs["text"].cast("string").alias("text")
    )
    return three.mapInArrow(run, RESULT)
