"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per rule; policies are versioned
bit masks, so a new policy, or what one rule costs, is a bitwise look at the ledger and needs no text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import CUT

#: Rule bits. `bad` is SQL over the measurements.
RULES = [
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("many_symbols", "10 * n_symbols > 3 * word_chars"),
    ("duplicate_lines", "n_dup_lines >= 5 and 10 * n_dup_lines > 7 * n_lines"),
    ("long_words", "word_chars > 60 * n_words"),
]
BASE = 0b00011
#: Policies: which bits reject, by version. Version 1 is the base alone.
POLICIES = {1: BASE, 2: 0b11111}
CURRENT = 2

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

SPACE = " \t\n\x0b\f\r"

#: The windows of a text by hash, then the sorted positions of those that occur twice or more.
SORTED = "sort_array(transform(hs, (h, i) -> named_struct('h', h, 'i', i)))"
REPEATED = """sort_array(filter(transform(ws, (w, k) ->
  if((k > 0 and get(ws, k - 1).h = w.h) or get(ws, k + 1).h = w.h, w.i, -1)), i -> i >= 0))"""
#: Words covered by windows at sorted positions: each adds what the next one does not cover again.
COVERED = """cast(aggregate(at, named_struct('sum', 0, 'last', -5),
  (acc, i) -> named_struct('sum', acc.sum + least(5, i - acc.last), 'last', i), acc -> acc.sum) as bigint)"""


def measurements(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every whole text, by built-in functions only."""
    text = F.coalesce(docs["text"], F.lit(""))
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    trimmed = F.btrim("text", F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, CUT))
    base = base.select("doc_id", "text", words.alias("words"))
    full = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    window = "xxhash64(wh[i], wh[i + 1], wh[i + 2], wh[i + 3], wh[i + 4])"
    windows = f"if(size(wh) < 5, array(), transform(sequence(0, size(wh) - 5), i -> {window}))"
    one = base.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.transform(full, lambda line: F.xxhash64(line)).alias("lines"),
        F.expr(f"transform(array(transform(words, w -> xxhash64(w))), wh -> {windows})[0]").alias("hs"),
    )
    # Most texts repeat no window: only the others sort theirs.
    covered = f"transform(array({SORTED}), ws -> transform(array({REPEATED}), at -> {COVERED})[0])[0]"
    repeated = f"if(size(array_distinct(hs)) = size(hs), 0L, {covered})"
    return one.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(repeated).alias("n_repeat_words"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: measurements and `failed`, the bits of the rules it fails.

    Null and empty texts have no words and fail few_words; repeated rows are measured each; empty input gives no rows;
    other columns of `docs` are not looked at, whatever their names.
    """
    bits = [F.expr(f"if({bad}, {1 << i}L, 0L)") for i, (_, bad) in enumerate(RULES)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measurements(docs).withColumn("failed", failed)


def verdicts(book: DataFrame, version: int = CURRENT) -> DataFrame:
    """The ledger with `base_failed` and `kept` under a policy. A base failure always rejects."""
    rejects = F.lit(POLICIES[version] | BASE).cast("long")
    return book.withColumns(
        {
            "base_failed": F.col("failed").bitwiseAND(F.lit(BASE).cast("long")) != 0,
            "kept": F.col("failed").bitwiseAND(rejects) == 0,
        }
    )


def ablations(book: DataFrame, version: int = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that only it rejects, and that stay without it.

    Masks are counted first, so one row per distinct mask (2^rules at most) meets the rules.
    """
    policy = POLICIES[version] | BASE
    masks = book.select(F.col("failed").bitwiseAND(F.lit(policy).cast("long")).alias("m"))
    masks = masks.groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, (name, _) in enumerate(RULES) if policy >> i & 1]
    )
    each = masks.select("m", "n", F.inline(rules))
    hit = F.col("m").bitwiseAND(F.col("bit")) != 0
    only = F.col("m") == F.col("bit")
    without = F.col("m").bitwiseAND(F.bitwise_not("bit")) == 0
    return each.groupBy("rule", "bit").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("fail"),
        F.sum(F.when(only, F.col("n")).otherwise(0)).alias("only_this"),
        F.sum(F.when(without, F.col("n")).otherwise(0)).alias("kept_without"),
        F.bit_or("m").alias("seen_bits"),
    )
