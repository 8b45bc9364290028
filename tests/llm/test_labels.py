import random
import time

import brute
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattloom.llm import decontaminate, pii, simhash, toxicity

SPAN = ("kind", "start", "end")


def triples(spans):
    return [tuple(s[c] for c in SPAN) for s in spans]


PARTS = st.sampled_from(
    ["a@b.c", "@", "x.y", "+1", "(386) ", "555-0134", "4111111111111111", "4111 1111 1111 1111", " ", "-", "10.0.0.1", "999.1.1.1", "é", "%", "_", ".", "0", "7"]
)


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PARTS, max_size=14).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == brute.personal(text)


def test_candidates_are_clear_of_base_spans():
    text = "me (at) home (dot) org, +1 (386) 555-0134 or 386-555-0134; 2001:db8:0:0:1:2:3:4; v1.2.3"
    spans = pii.candidate_spans(text, pii.base_spans(text))
    assert [text[a:b] for _, a, b in spans] == ["me (at) home (dot) org", "386-555-0134", "2001:db8:0:0:1:2:3:4"]
    assert [k for k, _, _ in spans] == ["email", "phone", "ip"]


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, base string, start int")


def planted():
    rows = [(k, f"please phone me on +1 (386) 555-{1000 + k} today") for k in range(8)]
    rows += [(20, "please phone me on 386 555 2222 today"), (21, "invoice number 386 555 2222 paid"), (22, "order 386 555 9999 paid")]
    return rows + [(30, None), (31, ""), (20, "please phone me on 386 555 2222 today"), (None, "mail a@b.cd")]


def test_contexts_find_unseen_identifiers(spark):
    found = pii.spans(docs_frame(spark, planted())).collect()
    assert len(found) == len(planted())
    text = {i: t for i, t in planted()}
    for row in found:
        base = brute.personal(text[row["doc_id"]] or "")
        assert sorted(triples(row["base"])) == sorted(base)
        added = [s for s in triples(row["spans"]) if s not in base]
        assert added == ([("phone", 19, 31)] if row["doc_id"] == 20 else [])


def test_rounds_go_on_until_one_learns_nothing(spark):
    # Six levels of 20 identifiers; ten patterns stand beside a level and two of the next.
    patterns = {(level, k): [] for level in range(7) for k in range(20)}
    for level in range(6):
        for part in range(10):
            for one in [(level, k) for k in range(20)] + [(level + 1, 2 * part), (level + 1, 2 * part + 1)]:
                patterns[one].append(f"{level} {part} _")
    rows = [("phone", f"{level}-{k}", level == 0, found) for (level, k), found in patterns.items()]
    mentions = spark.createDataFrame(rows, "kind string, identity string, seed boolean, patterns array<string>")
    trusted, known = pii.trusted(mentions)
    assert {r["identity"] for r in known.collect()} == {f"{level}-{k}" for level in range(1, 7) for k in range(20)}
    assert trusted.count() == 60
    with pytest.raises(RuntimeError, match="did not settle in 3 rounds"):
        pii.trusted(mentions, 3)


def test_redaction(spark):
    docs = docs_frame(spark, planted())
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (20, "please phone me on <phone> today") in texts and (3, "please phone me on <phone> today") in texts
    assert (22, "order 386 555 9999 paid") in texts and (30, None) in texts and (None, "mail <email>") in texts
    assert out.count() == len(planted())


def test_redact_overlaps():
    assert pii.redact("abcdef", [("x", 1, 4), ("y", 2, 5)]) == "a<x>f"


def test_digest_order(spark):
    frame = spark.createDataFrame([([("phone", 1, 2), ("email", 9, 12), ("email", 3, 5)],)], "s array<struct<kind string,start int,end int>>")
    assert frame.select(pii.digest_text("s")).first()[0] == "email:3:5,email:9:12,phone:1:2"


def toxic_table(spark, count=600):
    rng = random.Random(4)
    words = [f"{a}{b}{c}" for a in ("lo", "mi", "ra", "te") for b in ("nu", "ka", "so", "pe") for c in ("x", "y", "zet", "")]
    bad = ["fooblar", "grumpfel", "snarkik", "zonkol", "blortex", "krimmon"]
    docs, labels = [], []
    for k in range(count):
        toxic = k % 6 == 0
        text = [rng.choice(words) for _ in range(40)]
        if toxic:
            for word in rng.sample(bad, 3):
                text[rng.randrange(40)] = word
        docs.append((k, " ".join(text), 1.0))
        if k % 3 != 2:
            labels.append((k, int(toxic), 0))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = toxic_table(spark)
    docs += [(9001, None, 0.0), (9002, "", 0.0), (5, docs[5][1], 0.0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, (0, 0, 1), (7, None, 0), (None, 1, 0)], "doc_id long, toxic int, text int")
    model = toxicity.train(frame, marks)
    rows = toxicity.scored(frame, model, ["doc_id"]).collect()
    assert len(rows) == len(docs) and all(0 <= r["_score"] <= 1 for r in rows)
    wrong = [r["doc_id"] for r in rows if (r["_score"] >= 0.5) != (r["doc_id"] % 6 == 0) and r["doc_id"] < 9000]
    assert len(wrong) <= 6
    assert {round(r["_score"], 6) < 0.5 for r in rows if r["doc_id"] > 9000} == {True}


def test_without_labels_of_both_kinds(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["_score"] < 1e-9 for r in toxicity.scored(frame, toxicity.train(frame, none), ["doc_id"]).collect()} == {True}
    assert toxicity.scored(frame.limit(0), toxicity.train(frame.limit(0), none), ["doc_id"]).collect() == []


def test_label_model_recovers_rates():
    rng = np.random.default_rng(0)
    hidden = rng.random(40_000) < 0.2
    rates = [(0.7, 0.02), (0.5, 0.05), (0.8, 0.01), (0.4, 0.02), (0.1, 0.6)]
    fired = np.array([np.where(hidden, rng.random(40_000) < a, rng.random(40_000) < b) for a, b in rates] + [np.zeros(40_000, bool)]).T
    fired[:, 5] = fired[:, 0]  # a copy of the first voter
    both = fired.astype(int).T @ fired.astype(int)
    model = toxicity.fit_label_model(len(fired), both, 0.2)
    assert np.allclose(model.toxic_rate[1:5], [a for a, _ in rates[1:]], atol=0.08)
    assert np.allclose(model.clean_rate[1:5], [b for _, b in rates[1:]], atol=0.03)
    assert model.weight[0] < model.weight[1] and model.correlation[0, 5] > 0.2


def test_posterior_equals_bayes_over_all_votes():
    rng = np.random.default_rng(5)
    toxic, clean, weight = rng.uniform(0.1, 0.9, 6), rng.uniform(0.1, 0.9, 6), rng.uniform(0.1, 1, 6)
    model = toxicity.LabelModel(0.2, toxic, clean, weight, np.zeros((6, 6)))
    for row in (rng.random((50, 6)) < 0.4).astype(float):
        kinds = []
        for prior, rates in ((0.2, toxic), (0.8, clean)):
            kinds.append(prior * np.prod([(r if f else 1 - r) ** w for r, f, w in zip(rates, row, weight)]))
        assert abs(model.posterior(row[None])[0] - kinds[0] / sum(kinds)) < 1e-12


def test_gold_labels_move_rates_only():
    model = toxicity.LabelModel(0.2, np.array([0.9, 0.5]), np.array([0.1, 0.5]), np.ones(2), np.zeros((2, 2)))
    fired, gold, count = np.array([[1.0, 0], [0, 1], [1, 1]]), np.array([True, True, False]), np.array([3, 1, 4])
    both = model.with_gold(fired, gold, count)
    assert np.allclose(both.toxic_rate, [(0.9 + 3.5 / 5) / 2, (0.5 + 1.5 / 5) / 2])
    assert np.allclose(both.clean_rate, [(0.1 + 4.5 / 5) / 2, (0.5 + 4.5 / 5) / 2])


def test_posteriors_are_not_the_gold_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    sample = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", 30_000)
    kinds = dict(tuple(r) for r in sample.groupBy(F.col("toxic") > 0).count().collect())
    model = toxicity._pick_cues(sample, kinds[True], kinds[False])
    found = toxicity._sample_features(sample, model)
    fired = np.array([toxicity.votes(f, model) for f, _, _ in found], float)
    gold, count = np.array([g for _, g, _ in found]), np.array([n for *_, n in found])
    total, both = toxicity._vote_moments(docs, "text", model)
    fitted = toxicity.fit_label_model(total, both, kinds[True] / count.sum()).with_gold(fired, gold, count)
    differs = (fitted.posterior(fired) >= 0.5) != gold
    assert 0 < count[differs].sum() < 0.1 * count.sum()


def test_a_million_digits_within_a_second():
    for text in ("7" * 1_000_000, "1." * 500_000, "1.2.3.4 " + "9" * 1_000_000 + ".1.2"):
        begin = time.perf_counter()
        found = pii.base_spans(text)
        assert time.perf_counter() - begin < 5
        assert all(kind == "ip" for kind, _, _ in found)


@pytest.mark.parametrize("extra", ["_row", "_print", "_key", "_added", "_kept0_", "row", "segment", "fingerprint", "root"])
def test_extra_columns_of_any_name_stay(spark, extra):
    rows = [(1, "write to a.b@example.org now", "x"), (2, "one two three four five six seven eight nine ten eleven", "y")]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, `{extra}` string")
    items = spark.createDataFrame([(5, "five six seven eight")], "item_id long, text string")
    assert [(r[0], r[2]) for r in decontaminate.clean(docs, items).select(*docs.columns).collect()] == [(1, "x")]
    assert sorted((r[0], r[2]) for r in simhash.keep_one(docs).select(*docs.columns).collect()) == [(1, "x"), (2, "y")]
    redacted = pii.redacted(docs)
    assert redacted.columns == docs.columns
    assert sorted((r[0], r[1], r[2]) for r in redacted.collect()) == [(1, "write to <email> now", "x"), (2, rows[1][1], "y")]


def test_words_that_stand_before_anything_are_not_trusted(spark):
    rows = [(k, f"she lives near the +1 (386) 555-{1000 + k}") for k in range(8)]
    rows += [(50 + k, f"contact phone: +1 (386) 555-{2000 + k}.") for k in range(12)]
    rows += [(100 + k, "near the house and the garden") for k in range(20)]
    rows += [(200, "near the 386 555 7777"), (201, "contact phone: 386 555 8888"), (202, "contact phone " + "0" * 15 + "7")]
    found = {r["doc_id"]: triples(r["spans"]) for r in pii.spans(docs_frame(spark, rows)).collect()}
    assert found[200] == [] and found[201] == [("phone", 15, 27)] and found[202] == []


def test_occurrences_equal_plain_counting(spark, monkeypatch):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["a", "B", "c", "7,", "d!"]) for _ in range(rng.randrange(40))) for _ in range(60)] + [None, ""]
    patterns = ["a _", "b c _", "a _ d", "zz _", "d _ d"]
    expected = dict.fromkeys(patterns, 0)
    for text in texts:
        words = pii._WORD.findall((text or "").lower())
        for k, word in enumerate(words):
            for name in (f"{word} _", " ".join([*words[k : k + 2], "_"]), f"{word} _ {words[k + 2]}" if k + 2 < len(words) else ""):
                if name in expected and (name != " ".join([*words[k : k + 2], "_"]) or len(words[k : k + 2]) == 2 or name == f"{word} _"):
                    expected[name] += 1
        if words and f"{words[-1]} _" in expected:
            expected[f"{words[-1]} _"] -= 1  # named twice for a last word
    monkeypatch.setattr(pii, "_CHUNK", 7)
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = pii.occurrences(frame, spark.createDataFrame([(p,) for p in patterns], "pattern string"))
    assert {r["pattern"]: r["n"] for r in found.collect()} == {p: n for p, n in expected.items() if n}


def test_contexts_are_whole_words_however_far():
    text = "Telephone" + "." * 500 + "555 0134" + "-" * 500 + "evenings"
    assert pii.contexts(text, [(509, 517)]) == [["telephone _", "telephone _ evenings"]]
