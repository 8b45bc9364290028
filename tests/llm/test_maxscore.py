import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import oracle
from wattloom.llm import maxscore


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, k=10, scale=1024, is_query=lambda i: i % 100 == 0):
    whole = [(i, tuple(math.floor(scale * c) for c in v)) for i, v in rows if i is not None and usable(v)]
    out = []
    for i, q in {(i, q) for i, q in whole if is_query(i)}:
        scored = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in whole if j != i)
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string, _x int, score double")
    return sorted(tuple(r) for r in maxscore.top_k(df, F.col("_id") % 100 == 0, **options).collect())


def table(vectors, ids=None):
    return [(i if ids is None else ids[i], v, "r", 1, 0.5) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("kind", ["dense", "sparse", "negative", "clusters"])
def test_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(maxscore, "SHARD_CELLS", 700)
    monkeypatch.setattr(maxscore, "SEED_CELLS", 200)
    monkeypatch.setattr(maxscore, "QUERY_CELLS", 30)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(420, 12))
    if kind == "sparse":
        x = np.abs(x) * (rng.random(x.shape) < 0.1)
    elif kind == "negative":
        x = -np.abs(x) * (rng.random(x.shape) < 0.3)
        x[::100] = np.abs(x[::100])
    elif kind == "clusters":
        x = np.round(x[rng.integers(0, 9, 420)], 1)
    rows = table(x.tolist())
    assert found(spark, rows) == brute([r[:2] for r in rows])
    assert found(spark, rows, k=3, scale=7) == brute([r[:2] for r in rows], 3, 7)


def test_nulls_ties_repeats_and_short_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0], None, [nan, 1.0], [inf, 0.0], [None, 1.0], [], [3.0], [1.0, 2.0, 9.0], [0.0, 0.0], [1.0, 2.0]]
    rows = table([*vectors, [-1.0, -1.0], [1.0, 2.0]], [0, 100, 200, 300, 400, 500, 6, 7, 8, 9, None, 9])
    rows += rows[:1] + [(-100, [0.5, 0.25], "", 0, 0.0)]
    assert found(spark, rows) == brute([r[:2] for r in rows])


def test_few_candidates_and_empty_table(spark):
    assert found(spark, table([[1.0]])) == []
    assert found(spark, table([[1.0], [2.0]])) == [(0, 1, 1, 1024 * 2048)]
    assert found(spark, []) == []


def test_scores_beyond_a_long(spark):
    with pytest.raises(Exception, match="may not fit a long"):
        found(spark, table([[1e12, 1e12], [1e12, 1e12]]))


def test_only_competitive_rows_are_probed():
    rng = np.random.default_rng(1)
    rows = (np.abs(rng.normal(size=(4_000, 40))) * (rng.random((4_000, 40)) < 0.05) * 100).astype(np.int64)
    shard = maxscore.Postings(np.arange(4_000), rows)
    query = rows[0]
    terms = np.flatnonzero(query)
    scores = rows @ query
    least = int(np.sort(scores)[-10])
    alive, sums = shard.search(terms, query[terms], least)
    assert sorted(alive) == sorted(np.flatnonzero(scores >= least)) and (sums == scores[alive]).all()
    # Some of the query's terms are non-essential at that bound.
    bounds = np.sort(query[terms] * shard.high[terms])
    assert bounds[0] < least


def test_query_matches_sql(spark, sf_dir):
    df = driver.queries()["op11_maxscore"](spark, sf_dir)
    assert oracle.difference(df, oracle.connect(sf_dir), driver.oracle_sql()["op11_maxscore"]) is None
