"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a 64-bit fingerprint gets a non-zero vector of radius + 1 bits. Each non-zero vector v makes one table, keyed by
the fingerprint's bits whose vector has an odd product with v. Radius or fewer differing bits span at most radius
dimensions, so some v is orthogonal to all of them, and in its table the two fingerprints collide: no pair is missed.

Fingerprints that share a bucket with another one are checked exactly without pairing the members of a bucket: two of
them differ in at most 2h bits just if some value lies within h bits of both. Each member emits those values (hubs), so a
bucket of any size costs a fixed number of rows for each member, and all that share a hub are linked to its smallest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import materialise
from areastats.llm.components import components

BITS = 64
SEED = 42


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def masks(radius: int) -> list[int]:
    """One bit mask per table: 2^(radius + 1) - 1 of them."""
    vectors = (1 << (radius + 1)) - 1
    return [
        signed(sum(1 << i for i in range(BITS) if ((i % vectors + 1) & v).bit_count() & 1)) for v in range(1, vectors + 1)
    ]


def flips(radius: int) -> list[int]:
    """What to flip to reach every value within radius / 2 bits."""
    if radius % 2:
        raise ValueError("the exact check needs an even radius")
    return [signed(sum(1 << i for i in c)) for n in range(radius // 2 + 1) for c in combinations(range(BITS), n)]


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of a UTF-8 text: a bit is set if over half of its shingles' hashes have it; 0 without words."""
    words = text.lower().split()  # both treat ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype="<u8")
    else:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[: len(words) - width + 1].tolist()
        digest = xxhash.xxh64_intdigest
        pairs = zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp is the 64-bit fingerprint as a signed long. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py() or b"", width) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    two = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return two.mapInArrow(run, "doc_id long, fp long")


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a, b) between distinct fingerprints `fp` that connect exactly those within `radius` bits, chains included."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).cast("long").alias("m")) for t, m in enumerate(masks(radius))])
    keyed = prints.select("fp", F.inline(tables)).select("fp", "t", F.col("fp").bitwiseAND(F.col("m")).alias("key"))
    crowded = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("t", "key")
    members = materialise(keyed.join(crowded, ["t", "key"]).select("fp").distinct())
    hubs = members.select("fp", F.explode(F.array(*[F.lit(x).cast("long") for x in flips(radius)])).alias("x"))
    hubs = hubs.select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("hub"))
    first = hubs.groupBy("hub").agg(F.min("fp").alias("root"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = hubs.join(first.select("hub", "root"), "hub").where("fp <> root")
    return met.select(F.col("fp").alias("a"), F.col("root").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links) and root (one fingerprint for each component; an
    id that repeats may be the smallest of several) of every row of `docs`.

    Null, empty and wordless texts have fingerprint 0 and link like any other. Equal fingerprints are one node, so
    copies cost nothing beyond their own row. Null ids never are the smallest, unless a component has no other. Repeated
    rows are kept. Empty input gives no rows. Other columns are not looked at.
    """
    prints = materialise(fingerprints(docs, width))
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    tree = components(links(nodes.select("fp"), radius))
    rooted = nodes.join(tree, nodes["fp"] == tree["node"], "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(lowest, "root").select(F.col("fp").alias("l_fp"), "component_id", "root")
    return prints.join(labels, prints["fp"] == labels["l_fp"]).select("doc_id", "fp", "component_id", "root")


def one_of_each(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """One row of each component, with the columns of `docs`: that of the smallest id, then fingerprint, then row.

    A component of null ids only keeps one of those. Texts are not moved: the ids that lose all their rows are taken out of
    `docs`. Only where an id keeps one of several rows are these rows met again and compared by fingerprint. Null and empty
    texts are one component; empty input gives no rows.
    """
    near = near_duplicates(docs, width, radius)
    keys = materialise(near.groupBy("doc_id", "fp").agg(F.min("root").alias("root"), F.count(F.lit(1)).alias("rows")))
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("one")
    first = keys.groupBy("root").agg(smallest).select(F.col("one.doc_id").alias("f_id"), F.col("one.fp").alias("f_fp"))
    kept = (F.col("doc_id").eqNullSafe(F.col("f_id"))) & (F.col("fp") == F.col("f_fp"))
    marked = keys.join(first, kept, "left").select("doc_id", "fp", "rows", F.col("f_fp").isNotNull().alias("kept"))
    marked = materialise(marked)
    ids = marked.groupBy(F.col("doc_id").alias("k_id")).agg(F.max("kept").alias("any"), F.sum("rows").alias("rows"))
    ids = materialise(ids.where("not any or rows > 1"))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("k_id"))
    once = docs.join(ids.select("k_id"), same, "left_anti")
    several = ids.where("any").select("k_id")
    if several.isEmpty():
        return once
    again = docs.join(several, same, "left_semi")
    row = F.struct(*[again[c] for c in docs.columns]).alias("row")
    row = again.select(again["doc_id"].cast("long").alias("doc_id"), print_of(width)(again["text"].cast("string")).alias("fp"), row)
    chosen = marked.where("kept").select(F.col("doc_id").alias("c_id"), F.col("fp").alias("c_fp"))
    met = row.join(chosen, row["doc_id"].eqNullSafe(F.col("c_id")) & (row["fp"] == F.col("c_fp")), "left_semi")
    return once.unionByName(met.groupBy("doc_id", "fp").agg(F.min("row").alias("row")).select("row.*"))


def print_of(width: int):
    """The fingerprint of a column of texts."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t.as_py() or b"", width) for t in texts.cast(pa.binary())]
        return pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return run
