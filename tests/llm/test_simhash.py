import random

import brute
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wattloom.llm import common, simhash


def rows_of(df):
    return {(r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in df.collect()}


@given(st.text(alphabet="aB \n\x0b é", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute.simhash(text)


def test_groups_equal_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(300)]
    base = [[rng.choice(words) for _ in range(120)] for _ in range(30)]
    rows = []
    for k in range(150):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(120)] = rng.choice(words)
        rows.append((k, " ".join(text)))
    rows += [(200, None), (201, ""), (202, "one two"), (203, "One  two"), (204, "x " * 30_000)]
    docs = spark.createDataFrame([(i, t, i, "s") for i, t in rows], "doc_id long, text string, fingerprint long, root string")
    assert rows_of(simhash.groups(docs)) == brute.simhash_groups(rows)


@pytest.mark.parametrize("members", [16, 40, 10_000])
def test_tree_finds_every_link(spark, members):
    rng = np.random.default_rng(2)
    points = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    near = points[rng.integers(0, 300, 200)].copy()
    for k in range(len(near)):
        for bit in rng.choice(64, rng.integers(1, 5), replace=False):
            near[k] ^= np.uint64(1) << np.uint64(bit)
    points = np.unique(np.concatenate([points, near]))
    classes = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fingerprint long")
    roots = dict(tuple(r) for r in common.components(simhash.links(classes, members)).collect())
    apart = np.bitwise_count(points[:, None] ^ points[None, :])
    order = np.argsort(points.view(np.int64))
    signed = points.view(np.int64)[order]
    expected = brute.components(len(points), [(i, j) for i, j in zip(*np.nonzero(apart[np.ix_(order, order)] <= 3)) if i != j])
    for k, value in enumerate(signed.tolist()):
        assert roots.get(value, value) == signed[expected[k]]


def test_blocks_of_a_dense_shard():
    far = 0x1F << 40
    points = np.array([0, 1, 3, far, far + 1], np.uint64)
    block = np.array([0, 1, 0, 1, 0])
    edges = simhash.close_edges(points, block, True)
    assert brute.components(5, edges) == [0, 0, 0, 3, 3]


def test_keeps_one_of_each_group(spark):
    rows = [(3, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", "y"), (None, "a b c d", "z"), (7, "q r s t", None), (None, "alone here now", "n"), (None, "alone here  now", "m")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, component_id string"))
    rows = sorted(map(tuple, kept.collect()), key=str)
    assert rows[:2] == [(1, "a b c d", "y"), (7, "q r s t", None)]
    assert len(rows) == 3 and rows[2][0] is None and rows[2][2] in ("n", "m")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.groups(docs).collect() == []
    assert simhash.keep_one(docs).collect() == []


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=25))
def test_components(spark, edges):
    found = dict(tuple(r) for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    expected = brute.components(13, edges)
    assert found == {k: r for k, r in enumerate(expected) if k != r}


def test_components_of_a_long_path(spark):
    edges = [(k + 1, k) for k in range(200)]
    random.Random(0).shuffle(edges)
    found = common.components(spark.createDataFrame([*edges, (None, 3), (4, 4)], "a long, b long")).collect()
    assert {r["root"] for r in found} == {0} and len(found) == 200
