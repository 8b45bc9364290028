import random

import brute

from wattloom.llm import decontaminate


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, items string, n_hit int"),
        spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string"),
    )


def test_equals_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(40)] + ["Éa", "x1"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate([30, 12, 10, 9, 6, 5, 4, 2, 1])]
    items += [(20, None), (21, "..."), (22, items[0][1]), (100, items[1][1] + " " + text(8))]
    docs = []
    for k in range(60):
        parts = [text(rng.randint(0, 30)), rng.choice(items)[1] or "", text(5), (rng.choice(items)[1] or "").upper()]
        docs.append((k, "; ".join(parts)))
    docs += [(90, None), (91, ""), (92, items[0][1]), (93, " ".join([items[0][1]] * 200)), (94, items[0][1][:40]), (95, docs[0][1])]
    report = decontaminate.report(*frames(spark, docs, items)).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in report)
    assert got == sorted(brute.decontaminated(docs, items))
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in report)


def test_clean_keeps_untouched_documents(spark):
    leak = " ".join(f"k{n}" for n in range(14))
    docs = [(1, "fine text"), (2, f"before {leak} after"), (2, "same id, fine"), (None, None), (4, leak[:-4])]
    frame, items = frames(spark, docs, [(1, leak)])
    kept = decontaminate.clean(frame, items)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id is not null").collect()) == [(1, "fine text"), (2, "same id, fine")]
    assert kept.where("doc_id is null").count() == 1


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [])
    assert [tuple(r) for r in decontaminate.report(docs, items).collect()] == [(1, 2, 0, [], False)]
    docs, items = frames(spark, [], [(1, "a b")])
    assert decontaminate.report(docs, items).collect() == []


def test_stretches():
    import numpy as np

    inside = np.array([1, 1, 0, 1, 1, 1, 0, 1], bool)
    assert decontaminate.stretches(inside, 2) == [(0, 2), (3, 3)]
    assert decontaminate.stretches(np.zeros(0, bool), 1) == []
