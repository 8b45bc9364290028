import brute
import numpy as np
import pytest

from wattloom.llm import grid_join


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows if r["vec_id"] is not None)
    return {(r["vec_id"], r["n_links"], r["component_id"]) for r in rows}


@pytest.mark.parametrize("rows", [7, 2_048])
def test_equals_brute_force(spark, rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    vectors = [(centres[rng.integers(12)] + rng.normal(size=16) * rng.choice([0.05, 0.25, 1])).astype(np.float32).tolist() for _ in range(180)]
    vectors += [vectors[0], vectors[0], vectors[5]]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e-30] * 16, [3e38] * 16]
    table = list(enumerate([*vectors, *odd]))
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in table], "vec_id long, embedding array<float>, vector string, n_links int")
    assert found(grid_join.groups(df, rows=rows)) == brute.vector_groups(table)


def test_clustered_vectors_are_mostly_skipped(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 8))
    vectors = [(centres[k % 60] + rng.normal(size=8) * 0.05).astype(np.float32).tolist() for k in range(6_000)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    assert grid_join.compared_share(df) < 0.1
    assert grid_join.groups(df).select("component_id").distinct().count() <= 60


def test_intervals_hold_every_link():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 32))
    rows = np.array(sorted((centres[k % 20] + rng.normal(size=32) * 0.3).tolist() for k in range(900)))
    axes = np.linalg.qr(rng.normal(size=(32, 32)))[0][:, :12]
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    links, compared = grid_join.compare_blocks(rows[:500], rows[500:], False, 0.9, {32: axes})
    assert (links == (unit[:500] @ unit[500:].T >= 0.9)).all() and links.any() and compared <= 200_000


def test_border_of_the_cosine(spark):
    a = [1.0, 0.0]
    near = [0.9, float(np.sqrt(1 - 0.81))]
    table = [(1, a), (2, near), (3, [0.8999999, float(np.sqrt(1 - 0.8999999**2))]), (4, [-1.0, 0.0])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    assert found(grid_join.groups(df)) == brute.vector_groups(table)


def test_repeated_and_missing_ids(spark):
    table = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01]), (5, [0.0, 1.0])]
    rows = grid_join.groups(spark.createDataFrame(table, "vec_id long, embedding array<float>")).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in rows) == [("1", 2, 1), ("1", 2, 1), ("5", 0, 5), ("None", 2, 1)]


def test_empty_table(spark):
    assert grid_join.groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
