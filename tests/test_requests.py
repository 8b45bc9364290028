"""Request answering against a plain per-request evaluation."""

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from wattloom import schemas
from wattloom.operators import publish, requests, rollup, upsert
from wattloom.operators.compare import investigation
from wattloom.operators.publish import with_account_id
from wattloom.operators.skew import hot_keys, skewed_join

GOOD = [
    {"operation": "list_accounts"},
    {"operation": "account_details", "account_id": "DEMO-1"},
    {"operation": "investigate_usage", "account_id": "DEMO-1", "month": "2018-01"},
    {"operation": "investigate_usage", "account_id": "DEMO-1", "month": "2018-02"},
    {"operation": "explain_usage", "account_id": "DEMO-1", "month": "2018-01"},
    {"operation": "explain_usage", "account_id": "DEMO-2", "month": "2018-02"},
]
BAD = {
    # Each rule at its border. The document must be an object ...
    '{"operation":': "MALFORMED_REQUEST",
    '"list_accounts"': "MALFORMED_REQUEST",
    '[{"operation":"list_accounts"}]': "MALFORMED_REQUEST",
    "false": "MALFORMED_REQUEST",
    "": "MALFORMED_REQUEST",
    # ... with a known operation, letter for letter ...
    '{"operation":null}': "UNSUPPORTED_OPERATION",
    '{"operation":"List_accounts"}': "UNSUPPORTED_OPERATION",
    '{"operation":"list_accounts "}': "UNSUPPORTED_OPERATION",
    '{"operation":["list_accounts"]}': "UNSUPPORTED_OPERATION",
    # ... an account that is a text and not blank ...
    '{"operation":"account_details"}': "MISSING_FIELD",
    '{"operation":"account_details","account_id":""}': "MISSING_FIELD",
    '{"operation":"account_details","account_id":"\\t"}': "MISSING_FIELD",
    '{"operation":"account_details","account_id":{"id":"DEMO-1"}}': "MISSING_FIELD",
    # ... and a month between 01 and 12 of a four-digit year.
    '{"operation":"investigate_usage","account_id":"DEMO-1","month":"2018-00"}': "INVALID_MONTH_FORMAT",
    '{"operation":"investigate_usage","account_id":"DEMO-1","month":"2018-13"}': "INVALID_MONTH_FORMAT",
    '{"operation":"investigate_usage","account_id":"DEMO-1","month":"201-05"}': "INVALID_MONTH_FORMAT",
    '{"operation":"investigate_usage","account_id":"DEMO-1","month":"2018-05-01"}': "INVALID_MONTH_FORMAT",
    '{"operation":"explain_usage","account_id":"DEMO-1","month":201805}': "INVALID_MONTH_FORMAT",
    '{"operation":"explain_usage","account_id":"DEMO-1"}': "INVALID_MONTH_FORMAT",
    '{"operation":"account_details","account_id":"DEMO-77"}': "INVALID_REQUEST",
    '{"operation":"explain_usage","account_id":"DEMO-1","month":"2019-01"}': "INVALID_REQUEST",
    '{"operation":"explain_usage","account_id":"DEMO-1","month":"0000-01"}': "INVALID_REQUEST",
}


def days(spark, nan=False):
    rows = []
    for building in (1, 2, 3):
        for month, day in ((1, 1), (1, 2), (2, 1)):
            kwh = building + day / 8 + month
            if nan and building == 3:
                kwh = float("nan")
            rows.append(
                (building, "AL", "G0101130", "Fort Benning", date(2018, month, day), 24,
                 kwh, kwh, 0.5, 0.25, 0.125, 4.0, 60.0, 50.0, 70.0, 0.0, 5.0, 50.0, 3.0)
            )
    layout = [f for f in schemas.DAILY.fields if f.name != "account_id"]
    return spark.createDataFrame(rows, schemas.T.StructType(layout))


@pytest.fixture(scope="module")
def snapshot(spark):
    daily = days(spark)
    monthly = rollup.monthly_rollup(daily)
    accounts = daily.select("building_id").distinct().select(
        *[
            F.col("building_id") if f.name == "building_id"
            else F.concat(F.lit("DEMO-"), "building_id").alias("account_id") if f.name == "account_id"
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.ACCOUNTS.fields
        ]
    )
    metadata = spark.createDataFrame(
        [("s1", 3, "t1", "d", "k", True, "m", 65.0)], schemas.METADATA
    )
    return {
        "accounts": accounts,
        "daily_usage": with_account_id(daily),
        "monthly_usage": with_account_id(monthly),
        "investigations": with_account_id(investigation(monthly)),
        "metadata": metadata,
    }


def ask(spark, snapshot, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, request_json string")
    rows = requests.answer(frame, snapshot, "/snapshots/accounts").collect()
    assert sorted(r.n for r in rows) == list(range(len(texts)))
    return {r.n: (r, json.loads(r.response_json)) for r in rows}


def test_right_requests_get_their_documents(spark, snapshot):
    got = ask(spark, snapshot, [json.dumps(g) for g in GOOD])
    results = []
    for n, request in enumerate(GOOD):
        row, response = got[n]
        assert row.ok and response["ok"] and row.error_code is None
        assert response["result"]["operation"] == request["operation"]
        assert response["result"]["metadata"] == {
            "created_at_utc": "t1", "dataset": "d", "data_type": "k",
            "weather_alignment_verified": True, "weather_alignment_method": "m",
            "degree_day_base_f": 65.0,
        }
        results.append(response["result"]["data"])

    assert results[0] == {"accounts_at": "/snapshots/accounts", "account_count": 3}

    details = results[1]
    assert details["account"]["account_id"] == "DEMO-1"
    assert "county_code" in details["account"]  # nulls are kept
    assert [d["usage_date"] for d in details["daily_usage"]] == ["2018-01-01", "2018-01-02", "2018-02-01"]
    assert [m["usage_month"][:7] for m in details["monthly_usage"]] == ["2018-01", "2018-02"]

    first, second = results[2], results[3]
    assert first["comparison_available"] is False and first["comparison"]["previous_month"] is None
    assert second["comparison_available"] is True
    assert second["comparison"]["electricity_change_kwh"] == 3.125 - 4.375
    assert second["explanation_scope"] == requests.EXPLANATION_SCOPE
    assert "explanation" not in second

    alone, compared = results[4]["explanation"], results[5]["explanation"]
    assert alone == {
        "text": "Modeled electricity usage for this month was 4.38 kWh. Previous-month data is "
        "unavailable, so a monthly comparison cannot be provided.",
        "source": "no_comparison",
        "model": None,
    }
    assert compared["source"] == "fallback"
    assert compared["text"] == (
        f"Modeled electricity usage was {4.125:.2f} kWh, compared with {6.375:.2f} kWh in the "
        f"previous month. Total usage decreased by {2.25:.2f} kWh. Average daily usage was "
        f"{4.125:.2f} kWh, compared with {3.1875:.2f} kWh previously. Weather attribution and "
        "bill calculations are not included."
    )


def test_wrong_requests_get_one_error_each(spark, snapshot):
    got = ask(spark, snapshot, list(BAD))
    for n, (document, code) in enumerate(BAD.items()):
        row, response = got[n]
        assert not row.ok and row.error_code == code, document
        assert response["ok"] is False
        assert response["error"]["code"] == code and response["error"]["message"]


def test_a_null_request_is_malformed(spark, snapshot):
    assert ask(spark, snapshot, [None])[0][0].error_code == "MALFORMED_REQUEST"


def test_numbers_json_cannot_carry_fail_only_their_own_request(spark, snapshot):
    broken = dict(snapshot)
    broken["daily_usage"] = with_account_id(days(spark, nan=True))
    texts = [json.dumps({"operation": "account_details", "account_id": f"DEMO-{n}"}) for n in (1, 3)]
    got = ask(spark, broken, texts)
    assert got[0][0].ok and got[1][0].error_code == "INVALID_REQUEST"


def test_listing_names_the_published_rows(spark, snapshot):
    frame = spark.createDataFrame([('{"operation":"list_accounts"}',)], "request_json string")
    answered = requests.answer(frame, snapshot, listing_at="/snapshots/accounts").first()
    listing = {"accounts_at": "/snapshots/accounts", "account_count": snapshot["accounts"].count()}
    assert json.loads(answered.response_json)["result"]["data"] == listing


def test_evidence_is_the_investigation_without_text(spark, snapshot):
    frame = spark.createDataFrame([(json.dumps(GOOD[5]),)], "request_json string")
    checked = requests.validate(requests.parse(frame))
    located = requests.locate(checked, snapshot["accounts"], snapshot["investigations"])
    document = json.loads(located.select(requests.evidence(snapshot["metadata"])).first()[0])
    assert set(document) == {"operation", "metadata", "data"}
    assert set(document["data"]) == {
        "account_id", "comparison_available", "comparison", "explanation_scope",
    }


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    # A third of the rows share one key; some keys are null or unknown.
    many = spark.range(9000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") % 800)
        .cast("int")
        .alias("k"),
    )
    one = spark.range(500).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    assert [r.k for r in hot_keys(many, ["k"]).collect()] == [7]
    salted, plain = skewed_join(many, one, ["k"], how), many.join(one, "k", how)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_no_task_gets_much_more_than_the_others(spark):
    # A third of the rows, all alike, share one key, and a tenth have none.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        many = spark.range(60_000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .when(F.col("id") % 10 != 1, (F.col("id") % 5_000).cast("string"))
            .alias("k")
        )
        one = spark.range(5_000).select(F.col("id").cast("string").alias("k"), "id").union(
            spark.createDataFrame([("hot", -1)], "k string, id long")
        )
        joined = skewed_join(many, one, ["k"], "left", spread_by=F.monotonically_increasing_id())
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == 60_000 and len(sizes) == 40
        assert sizes[-1] <= 2 * sizes[20]
        # As many pieces as its rows call for, and never more pieces than rows.
        salts = {r.k: r["_salts"] for r in hot_keys(many, ["k"]).collect()}
        assert set(salts) == {"hot"} and 100 <= salts["hot"] <= 200
        few = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
        assert {r.k: r["_salts"] for r in hot_keys(few, ["k"]).collect()} == {"a": 1, "b": 2}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="module")
def stored(spark, snapshot, tmp_path_factory):
    """The snapshot as published, one account to a folder."""
    root = str(tmp_path_factory.mktemp("published"))
    rows = [snapshot[n].drop("account_id") for n in ("daily_usage", "monthly_usage", "investigations")]
    gaps = rows[0].limit(0)
    publish.publish_snapshot(root, snapshot["accounts"], *rows, gaps, accounts_per_bucket=1)
    return publish.read_snapshot(spark, root)


def test_published_datasets_are_whole(snapshot, stored):
    for name in publish.DATASETS:
        columns = snapshot[name].columns
        assert sorted(map(str, stored[name].select(*columns).collect())) == sorted(map(str, snapshot[name].collect()))


def test_only_folders_of_the_accounts_asked_for_are_read(spark, stored):
    frame = spark.createDataFrame([(json.dumps(GOOD[1]),)], "request_json string")
    checked = requests.validate(requests.parse(frame)).filter("operation = 'account_details'")
    details = requests.asked_details(checked, stored)
    assert [len(r.daily_usage) for r in details.collect()] == [3]
    plan = details._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and ("usage_date" in line or "usage_month" in line)]
    assert len(scans) >= 2 and all("dynamicpruning" in line for line in scans)


def test_answers_of_a_published_snapshot(spark, snapshot, stored):
    texts = [json.dumps(g) for g in GOOD] + list(BAD)
    plain, published = ask(spark, snapshot, texts), ask(spark, stored, texts)
    described = stored["metadata"].drop("snapshot_id", "schema_version").first().asDict()
    for n in plain:
        expected = plain[n][1]
        if "result" in expected:
            expected["result"]["metadata"] = described
        assert published[n][1] == expected


def test_one_shared_read_of_the_snapshot(spark, stored):
    frame = spark.createDataFrame([(json.dumps(g),) for g in GOOD], "request_json string")
    plan = requests.answer(frame, stored, "/a")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 15
    assert plan.count("Subquery") <= 8


def test_written_answers_leave_nothing_staged(spark, snapshot, tmp_path, monkeypatch):
    staged = []
    scratch = upsert.scratch_dir
    monkeypatch.setattr(upsert, "scratch_dir", lambda *a: staged.append(scratch(*a)) or staged[-1])
    frame = spark.createDataFrame([(json.dumps(g),) for g in GOOD], "request_json string")
    requests.respond(frame, snapshot, "/a", str(tmp_path / "answers"))
    assert spark.read.parquet(str(tmp_path / "answers")).filter("ok").count() == len(GOOD)
    assert len(staged) == 4 and not any(os.path.exists(p) for p in staged)


def test_the_response_all_who_ask_share_is_made_and_read_once(spark, snapshot):
    """Each request for details got a text of all days of its account, and each was read back."""
    broken = dict(snapshot)
    broken["daily_usage"] = with_account_id(days(spark, nan=True))
    asked = ["DEMO-1"] * 30 + ["DEMO-2"] * 3 + ["DEMO-3"] * 2 + ["DEMO-77"] * 2
    texts = [json.dumps({"operation": "account_details", "account_id": a}) for a in asked]
    texts += [json.dumps(g) for g in GOOD] + list(BAD) + [None]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, request_json string")
    staged = {}

    def keep(df, label):
        staged[label] = upsert.stage(df, label)
        return staged[label]

    def length(answers):
        return answers.withColumn("length", F.length("response_json")).drop("response_json")

    read = requests.answer(frame, broken, "/a", keep, length)
    plain = requests.answer(frame, broken, "/a")
    expected = plain.select("n", "request_json", "ok", "error_code", F.length("response_json").alias("length"))
    assert read.columns == expected.columns and read.count() == len(texts)
    assert read.exceptAll(expected).isEmpty() and expected.exceptAll(read).isEmpty()
    answers = {r._account: r for r in staged["account-answers"].collect()}
    assert {a: r.ok for a, r in answers.items()} == {"DEMO-1": True, "DEMO-2": True, "DEMO-3": False, "DEMO-77": False}
    assert staged["account-answers"].count() == len(answers)


def test_arrays_of_usage_are_not_shuffled_again(spark, snapshot):
    """A full outer join of days and months forgot where they lie."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = [snapshot[n] for n in ("accounts", "daily_usage", "monthly_usage")]
        plan = requests.account_details(*parts)._jdf.queryExecution().sparkPlan().toString()
        final = requests.account_details(*parts)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" not in plan
    above = final[: final.index("ObjectHashAggregate")]
    assert above.count("Exchange hashpartitioning") <= 1  # of the account rows alone
