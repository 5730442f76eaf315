"""The registered training-data queries that have SQL against it, on the smallest driver tables."""

import math
from pathlib import Path

import duckdb
import pytest

from areastats.llm.registered import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")


def rows(values, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = [[None if isinstance(v, float) and math.isnan(v) else v for v in row] for row in values]
    return sorted((tuple(row[i] for i in order) for row in clean), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    frame, cursor = QUERIES[name](spark, SF), con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows(map(tuple, frame.collect()), frame.columns) == rows(cursor.fetchall(), names)


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_ablations_of_the_ledger(spark):
    """Per rule: who fails it, whom it alone rejects, and who would stay without it, against a count over the documents."""
    from areastats.llm import quality_rules as q

    book = q.ledger(spark.read.parquet(f"{SF}/documents.parquet"))
    failed = [r.failed for r in book.select("failed").collect()]
    for version, mask in q.POLICIES.items():
        policy = mask | q.BASE
        got = {r.rule: (r.bit, r.fail, r.only_this, r.kept_without) for r in q.ablations(book, version).collect()}
        want = {}
        for i, (rule, _) in enumerate(q.RULES):
            bit = 1 << i
            if policy & bit:
                own = [f & policy for f in failed]
                want[rule] = (bit, sum(f & bit > 0 for f in own), sum(f == bit for f in own), sum(f & ~bit == 0 for f in own))
        assert got == want
