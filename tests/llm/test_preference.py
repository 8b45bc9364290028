import pytest

import oracle
from wattloom.llm import preference, queries

SCHEMA = "conv_id long, turn long, role string, text string, prompt string"


def pairs(spark, rows):
    return {r["pair_id"]: r for r in preference.format_pairs(preference.label_neighbours(spark.createDataFrame(rows, SCHEMA))).collect()}


def turn(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_common_prefix_and_masks(spark):
    rows = [(0, 0, "user", "hi", "x"), (0, 1, "assistant", "good é", None), (0, 2, "user", "bye", None), (1, 5, "assistant", "bad", None), (1, 4, "user", "hi", None)]
    (row,) = pairs(spark, rows).values()
    assert (row["chosen_id"], row["rejected_id"], row["n_common"]) == (0, 1, 1)
    assert row["prompt"] == turn("user", "hi")
    assert row["chosen"] == turn("assistant", "good é") + turn("user", "bye") and row["rejected"] == turn("assistant", "bad")
    assert [row["chosen"][a:b] for a, b in row["chosen_mask"]] == ["good é<|im_end|>"]
    assert [row["rejected"][a:b] for a, b in row["rejected_mask"]] == ["bad<|im_end|>"]


def test_equal_lone_and_missing(spark):
    same = [(c, t, r, x, None) for c in (2, 3) for t, r, x in ((0, "system", None), (1, None, "y"), (1, None, "y"))]
    rows = [*same, (4, 0, "user", "only", None), (7, None, "assistant", "", None), (None, 0, "user", "lost", None)]
    found = pairs(spark, rows)
    assert set(found) == {1, 2, 3}
    assert found[1]["n_common"] == 3 and found[1]["chosen"] == found[1]["rejected"] == ""
    assert found[2]["rejected_id"] is None and found[2]["chosen"] == turn("user", "only") and found[2]["prompt"] == ""
    assert found[3]["chosen_id"] is None and found[3]["rejected"] == turn("assistant", "")


def test_table_of_pairs(spark):
    turns = spark.createDataFrame([(1, 0, "user", "q", ""), (9, 0, "user", "q", ""), (9, 1, "assistant", "a", "")], SCHEMA)
    table = spark.createDataFrame([(77, 9, 1)], "pair_id long, chosen_id long, rejected_id long")
    row = preference.format_pairs(preference.label_by_table(turns, table)).first()
    assert (row["pair_id"], row["n_common"], row["chosen"], row["rejected"]) == (77, 1, turn("assistant", "a"), "")


def test_long_conversation(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{t}", None) for c in (0, 1) for t in range(3000)] + [(1, 3000, "user", "more", None)]
    (row,) = pairs(spark, rows).values()
    assert row["n_common"] == 3000 and row["chosen"] == "" and row["rejected"] == turn("user", "more")


def test_replaced_replies(spark):
    rows = [
        (0, 0, "user", "q", "x"), (0, 1, "assistant", "one", None), (0, 2, "user", "more", None), (0, 3, "assistant", "two", None), (0, 4, "user", "bye", None),
        (1, 0, "user", "other", None), (1, 1, "assistant", "lent", None),
        (4, 0, "user", "alone", None), (4, 1, "assistant", None, None), (4, 1, "assistant", "twice", None), (4, 1, "assistant", "twice", None),
        (6, 0, "user", "no reply", None), (7, 0, "assistant", "first", None), (None, 0, "assistant", "lost", None),
    ]
    made = preference.replaced_replies(spark.createDataFrame(rows, SCHEMA))
    found = {r["pair_id"]: r for r in preference.format_pairs(made).collect()}
    assert set(found) == {0, 1, 4, 6, 7}
    assert found[0]["prompt"] == turn("user", "q") + turn("assistant", "one") + turn("user", "more")
    assert (found[0]["chosen_id"], found[0]["rejected_id"], found[0]["n_common"]) == (0, 1, 3)
    assert found[0]["chosen"] == turn("assistant", "two") + turn("user", "bye")
    assert found[0]["rejected"] == turn("assistant", "lent") + turn("user", "bye")
    assert [found[0]["rejected"][a:b] for a, b in found[0]["rejected_mask"]] == ["lent<|im_end|>"]
    assert (found[1]["rejected_id"], found[1]["rejected"]) == (0, turn("assistant", "two"))
    # Nobody lends to 4: one of its repeated last turns is emptied.
    assert found[4]["rejected_id"] == 4 and found[4]["rejected"].count("twice") == 1
    assert found[6]["rejected_id"] == 7 and found[6]["chosen"] == found[6]["rejected"] == ""
    assert found[7]["prompt"] == "" and found[7]["rejected"] == turn("assistant", "")


def test_pairs_of_the_query_share_a_prompt(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").where("role = 'assistant'")
    more = {r["conv_id"] for r in turns.groupBy("conv_id").agg({"turn": "max"}).where("`max(turn)` > 0").collect()}
    rows = queries.QUERIES["op10_preference"](spark, sf_dir).collect()
    assert more and all(r["prompt"] for r in rows if r["pair_id"] in more)


def test_empty_table(spark):
    assert pairs(spark, []) == {}
    assert preference.replaced_replies(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", ["op8_warc", "op10_preference"])
def test_query_matches_sql(spark, sf_dir, name):
    assert oracle.difference(queries.QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), queries.SQL[name]) is None


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.QUERIES["op10_preference"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
