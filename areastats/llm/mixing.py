"""Pivotal dependent rounding: whole numbers of copies whose words meet every source's target.

A source's rate is its target over its words. A document gets the whole part of the rate as copies; the fractional part
is rounded dependently: two documents are paired, words move at random from one to the other until one has a whole
number of copies, and the other goes on with the rest. The expectation of each document and the words of each pair stay
as they are, so a source misses its target by half of one document's words at most. Chunks of a source are folded in
parallel, and what they leave over is folded in the next level of a reduction tree.
"""

from __future__ import annotations

from functools import reduce
from math import floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from areastats.llm.common import WORD, materialise, small_frame

WEIGHTS = (5, 2, 1)
EPS = 1e-9


def targets(sources: list[tuple[str | None, int]], share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Words wanted of each source: weights 5, 2, 1 repeating over the sources by code point, null last; a target stops
    at `most` times the source's words and the excess is shared by weight among the others until none is above."""
    order = sorted(sources, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {name: WEIGHTS[i % len(WEIGHTS)] for i, (name, _) in enumerate(order)}
    words = dict(order)
    left, free, out = share * sum(words.values()), set(words), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > most * words[s]}
        if not over:
            return out | {s: unit * weight[s] for s in free}
        for s in over:
            out[s] = float(most * words[s])
        left, free = left - sum(out[s] for s in over), free - over
    return out


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(*keys(docs, "doc_id", "source", "size"))


def keys(docs: DataFrame, *names: str) -> list[Column]:
    size = F.regexp_count(F.coalesce(docs["text"], F.lit("")), F.lit(WORD))
    found = (docs["doc_id"].cast("long"), docs["source"], size.cast("long"))
    return [c.alias(n) for c, n in zip(found, names, strict=True)]


#: One step of the fold. `acc`: the document still open (d, s words, x of a copy) and the decided ones; `e`: the next one.
STEP = """aggregate(items, {start}, (acc, e) -> if(not acc.open,
  named_struct('d', e.d, 's', e.s, 'x', e.x, 'open', true, 'done', acc.done),
  transform(array(named_struct(
      'up', least(acc.s * (1D - acc.x), e.s * e.x), 'down', least(acc.s * acc.x, e.s * (1D - e.x)),
      'u', (xxhash64({seed}, {level}, acc.d, acc.s, e.d, e.s, src) & 9007199254740991L) / 9007199254740992D)),
    m -> transform(array(if(m.u * (m.up + m.down) < m.down, m.up, -m.down)),
    move -> transform(array(named_struct(
        'a', acc.x + move / acc.s, 'b', e.x - move / e.s)),
    n -> transform(array(named_struct(
        'a', if(n.a < {eps}, 0D, if(n.a > 1D - {eps}, 1D, n.a)), 'b', if(n.b < {eps}, 0D, if(n.b > 1D - {eps}, 1D, n.b)))),
    r -> if(r.a = 0D or r.a = 1D,
      if(r.b = 0D or r.b = 1D,
        named_struct('d', e.d, 's', e.s, 'x', r.b, 'open', false, 'done', acc.done
          || array(named_struct('d', acc.d, 's', acc.s, 'x', r.a), named_struct('d', e.d, 's', e.s, 'x', r.b))),
        named_struct('d', e.d, 's', e.s, 'x', r.b, 'open', true, 'done', acc.done
          || array(named_struct('d', acc.d, 's', acc.s, 'x', r.a)))),
      named_struct('d', acc.d, 's', acc.s, 'x', r.a, 'open', true, 'done', acc.done
        || array(named_struct('d', e.d, 's', e.s, 'x', r.b)))))[0])[0])[0])[0]))"""
START = """named_struct('d', cast(null as bigint), 's', 0L, 'x', 0D, 'open', false,
  'done', cast(array() as array<struct<d: bigint, s: bigint, x: double>>))"""


def pivot(units: DataFrame, seed: int, fan: int = 32) -> DataFrame:
    """Round the fractions x of (src, d, s): rows (src, d, s, x) with x 0 or 1.

    Chunks of about `fan` documents, drawn by hash, are folded from the largest document to the smallest, so the one
    left over tends to be small. The last one of a source has no partner and goes to the nearer whole number.
    """
    spark, level, decided = units.sparkSession, 0, []
    while True:
        counts = units.groupBy("src").count().collect()
        if not counts:
            break
        chunks = small_frame(
            spark, [{"src": r["src"], "chunks": -(-r["count"] // fan)} for r in counts], "src int, chunks bigint"
        )
        key = F.xxhash64(F.lit(seed), F.lit(level), "d", "s", "src")
        items = units.join(F.broadcast(chunks), "src").groupBy("src", "chunks", F.pmod(key, "chunks").alias("chunk"))
        folded = items.agg(F.collect_list(F.struct((-F.col("s")).alias("o"), key.alias("k"), "d", "s", "x")).alias("items"))
        step = STEP.format(start=START, seed=f"{seed}L", level=f"{level}L", eps=f"{EPS}D")
        folded = folded.withColumn("items", F.array_sort("items")).select("src", "chunks", F.expr(step).alias("f"))
        last = F.array(F.struct("f.d", "f.s", F.when(F.col("f.x") >= 0.5, 1.0).otherwise(0.0).alias("x")))
        ends = (F.col("chunks") == 1) & F.col("f.open")
        done = F.concat("f.done", F.when(ends, last).otherwise(F.expr("filter(f.done, y -> false)")))
        rest = F.when(~ends & F.col("f.open"), F.struct("f.d", "f.s", "f.x"))
        written = materialise(folded.select("src", done.alias("done"), rest.alias("rest")))
        decided.append(written.select("src", F.inline("done")))
        if all(r["count"] <= fan for r in counts):
            break
        units, level = written.where("rest is not null").select("src", "rest.d", "rest.s", "rest.x"), level + 1
    empty = units.select("src", "d", "s", "x").limit(0)
    return reduce(DataFrame.unionByName, decided) if decided else empty


def copies(docs: DataFrame, seed: int = 7, max_sources: int = 100_000) -> DataFrame:
    """How many copies of its rows each (doc_id, source, size) gets.

    Columns: doc_id, source, size, source_size, target, rows (how many rows of `docs` share the three), whole, more.
    `more` of the rows get whole + 1 copies, the others `whole`. The table of sources is the mix's own setting and comes
    to the driver; beyond `max_sources` of them it raises.

    Null texts have size 0; null sources are one source, the last; documents without words get the whole part only;
    repeated rows share the fraction, so a source meets its target however often a row repeats. Empty input gives no
    rows. Chunks and draws hang on ids and sizes alone, so reruns agree.
    """
    spark = docs.sparkSession
    narrow = materialise(sized(docs))
    stats = narrow.groupBy("source").agg(F.sum("size").alias("words")).limit(max_sources + 1).collect()
    if len(stats) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    words = {r["source"]: r["words"] for r in stats}
    goal = targets(list(words.items()))
    rows = []
    for i, s in enumerate(sorted(words, key=lambda s: (s is None, s or ""))):
        rate = goal[s] / words[s] if words[s] else 0.0
        whole = floor(rate + EPS)
        rows.append({"source": s, "src": i, "source_size": words[s], "target": goal[s], "whole": whole,
                     "part": max(0.0, rate - whole)})
    mix = small_frame(spark, rows, "source string, src int, source_size bigint, target double, whole bigint, part double")
    mix = mix.withColumnRenamed("source", "mix_source")
    units = narrow.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    units = units.join(F.broadcast(mix), F.col("source").eqNullSafe(F.col("mix_source"))).drop("mix_source")
    share = F.col("rows") * F.col("part")
    units = units.withColumn("sure", F.floor(share + EPS)).withColumn("x", F.greatest(F.lit(0.0), share - F.col("sure")))
    units = materialise(units)
    open_ = units.where((F.col("size") > 0) & (F.col("x") > EPS))
    rounded = pivot(open_.select("src", F.col("doc_id").alias("d"), F.col("size").alias("s"), "x"), seed)
    rounded = rounded.select(F.col("src").alias("r_src"), "d", "s", F.col("x").alias("up"))
    same = (F.col("src") == F.col("r_src")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("size") == F.col("s"))
    more = F.when(F.col("size") > 0, F.col("sure")).otherwise(0) + F.coalesce("up", F.lit(0.0)).cast("long")
    return units.join(rounded, same, "left").select(
        "doc_id", "source", "size", "source_size", "target", "rows", "whole", more.cast("long").alias("more")
    )


def mixed_words(docs: DataFrame, seed: int = 7) -> DataFrame:
    """Per row of `docs`: doc_id, size, source_size, target and the words taken of it."""
    each = copies(docs, seed).withColumn("nth", F.explode(F.expr("sequence(1L, rows)")))
    taken = F.col("size") * (F.col("whole") + F.when(F.col("nth") <= F.col("more"), 1).otherwise(0))
    return each.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself: every row of `docs` as often as it is taken, with the columns of `docs`.

    Only rows that repeat an id, source and size are numbered among each other; all others need no window.
    """
    plan = materialise(copies(docs, seed))
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *keys(docs, "k_id", "k_source", "k_size"))
    plan = plan.select(F.col("doc_id").alias("p_id"), F.col("source").alias("p_source"), F.col("size").alias("p_size"), "rows", "whole", "more")
    same = (
        F.col("k_id").eqNullSafe(F.col("p_id"))
        & F.col("k_source").eqNullSafe(F.col("p_source"))
        & (F.col("k_size") == F.col("p_size"))
    )

    def repeated(plan: DataFrame, nth) -> DataFrame:
        n = F.col("whole") + F.when(nth <= F.col("more"), 1).otherwise(0)
        # Both sides grow with the documents, so they meet by a shuffle whatever their size.
        met = own.join(plan.hint("merge"), same).withColumn("n", n.cast("int")).where("n > 0")
        return met.select("row", F.explode(F.array_repeat(F.lit(1), F.col("n"))).alias("one")).select("row.*")

    once = repeated(plan.where("rows = 1"), F.lit(1))
    if plan.where("rows > 1").isEmpty():
        return once
    nth = F.row_number().over(W.partitionBy("k_id", "k_source", "k_size").orderBy("k_id"))
    return once.unionByName(repeated(plan.where("rows > 1"), nth))
