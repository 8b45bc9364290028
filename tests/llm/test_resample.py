import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from brute import LOWER

import __spark_entry__ as driver
from wattloom.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest=1):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest=1, percent=10, least=20, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, longest)[1])
    t = Counter(bucket(f) for x in target for f in features(x, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows = []
    for i, text in docs:
        words, found = features(text, longest)
        weight = sum(gain(bucket(f)) for f in found)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(words)])
    eligible = sorted((r for r in rows if r[5] >= least and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for rank, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def run(spark, docs, target, **options):
    df = spark.createDataFrame([(i, t, 5, "w") for i, t in docs], "doc_id long, text string, rank int, weight string")
    wanted = spark.createDataFrame([(k, t, 1) for k, t in enumerate(target)], "item_id long, text string, doc_id int")
    return Counter(tuple(r) for r in resample.resampled(df.repartition(3), wanted, **options).collect())


def corpus(rng, count):
    words = [f"w{k}" for k in range(60)] + ["É", "ünï", "日本語", "x" * 40, "a" * 31, "b" * 32, "c" * 33, "Ab9", "ABCDEFGH", "abcdefgh1"]
    gaps = [" ", ", ", "\n", "_", "\t-", "é "]
    return [
        (k, "".join(words[rng.integers(len(words))] + gaps[rng.integers(len(gaps))] for _ in range(rng.integers(0, 60))))
        for k in range(count)
    ]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_equals_brute_force(spark, monkeypatch, longest):
    monkeypatch.setattr(resample, "TABLE_BYTES", 900)
    rng = np.random.default_rng(longest)
    docs = corpus(rng, 150) + [(200, None), (201, ""), (202, "\0\n"), (None, "w1 " * 30), (203, "W1 w2 " * 400)]
    target = [t for _, t in corpus(rng, 12)] + [None, ""]
    assert run(spark, docs, target, longest=longest, percent=30) == brute(docs, target, longest, 30)


def test_ties_and_repeats(spark):
    text = "one two three four " * 6
    docs = [(7, text)] * 4 + [(k, text) for k in range(20)]
    got = run(spark, docs, [text], percent=50)
    assert sorted(r[4] for r in got.elements() if r[4]) == list(range(1, 13))
    assert Counter(r[:4] for r in got.elements()) == Counter(r[:4] for r in brute(docs, [text], 1, 50).elements())


def test_few_buckets(spark):
    docs = corpus(np.random.default_rng(9), 40)
    assert run(spark, docs, ["w1 w2 w3"], buckets=3) == brute(docs, ["w1 w2 w3"], buckets=3)


def test_empty_tables(spark):
    assert run(spark, [], ["a b"]) == Counter()
    docs = corpus(np.random.default_rng(4), 30)
    assert run(spark, docs, []) == brute(docs, [])


def test_a_very_long_text(spark):
    docs = [(1, "alpha Beta " * 400_000), (2, "z" * 3_000_000), (3, "- " * 1_000_000)]
    assert run(spark, docs, ["alpha"]) == brute(docs, ["alpha"])


def test_hash_and_table_of_colliding_slots(monkeypatch):
    rng = np.random.default_rng(0)
    words = [bytes(rng.integers(97, 123, rng.integers(1, 90)).astype(np.uint8)) for _ in range(700)]
    data = resample.Bytes(np.frombuffer(b" ".join(words), np.uint8))
    sizes = np.array([len(w) for w in words])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    expected = [xxhash.xxh64_intdigest(w) for w in words]
    assert resample.xxhash64(data, starts, sizes).tolist() == expected
    # All keys equal: only the bytes tell runs apart.
    monkeypatch.setattr(resample, "xxhash64", lambda text, starts, sizes: np.zeros(len(starts), np.uint64))
    twice = resample.Table(data, np.concatenate([starts, starts]), np.concatenate([sizes, sizes]), 10_000)
    by_slot = {}
    for slot, word in zip(twice.slots.tolist(), words + words):
        assert by_slot.setdefault(slot, word) == word
    assert len(by_slot) == len(set(words)) and twice.counts.sum() == 1_400
    assert all(twice.buckets[s] == zlib.crc32(w) % 10_000 for s, w in by_slot.items())


def test_runs_stay_within_documents():
    buffer, starts, sizes, document, words = resample.runs(pa.array(["a b", None, "c", "d  e"]), 2)
    found = [(bytes(buffer.data[s : s + n]).decode(), d) for s, n, d in zip(starts, sizes, document)]
    assert sorted(found) == [("a", 0), ("a b", 0), ("b", 0), ("c", 2), ("d", 3), ("d e", 3), ("e", 3)]
    assert words.tolist() == [2, 0, 1, 2]


def test_query(spark, sf_dir):
    got = Counter(tuple(r) for r in driver.queries()["op13_interned_resampling"](spark, sf_dir).collect())
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert got == brute(docs, target)
