"""Answering batches of account requests in one plan.

Requests arrive as rows with a ``request_json`` column and leave as rows with a
``response_json`` column; all other columns travel along. Every request row gets
exactly one response row, whatever is wrong with it. The snapshot datasets are
keyed (checked when they are published), so lookups cannot fan out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions import periods, text
from wattloom.operators import conform
from wattloom.operators.publish import BUCKET
from wattloom.operators.skew import hot_keys, skewed_join
from wattloom.operators.upsert import Staging, stage

# Operations, error codes, messages and texts of the request contract.
OPERATIONS = ["list_accounts", "account_details", "investigate_usage", "explain_usage"]
MALFORMED = ("MALFORMED_REQUEST", "Request must be a JSON object.")
UNSUPPORTED = (
    "UNSUPPORTED_OPERATION",
    f"Unknown operation. Use one of: {', '.join(OPERATIONS)}.",
)
MISSING_ACCOUNT = ("MISSING_FIELD", "account_id is required and must be a non-empty string.")
BAD_MONTH = ("INVALID_MONTH_FORMAT", "month must use YYYY-MM format.")
UNKNOWN_ACCOUNT = (
    "INVALID_REQUEST",
    "Unknown account_id. Use list_accounts to see valid IDs.",
)
NO_SUCH_MONTH = ("INVALID_REQUEST", "month must use YYYY-MM format.")
NO_DATA = ("INVALID_REQUEST", "No data available for the requested month.")
NOT_JSON = ("INVALID_REQUEST", "Out of range float values are not JSON compliant")
EXPLANATION_SCOPE = (
    "Changes in modeled electricity end uses and aligned historical weather. "
    "Weather provides contextual evidence and does not establish causation. "
    "Bill calculations are not included."
)

# Sentences of an explanation, with the amounts between them.
ALONE = (
    "Modeled electricity usage for this month was ",
    ". Previous-month data is unavailable, so a monthly comparison cannot be provided.",
)
COMPARED = (
    "Modeled electricity usage was ",
    ", compared with ",
    " in the previous month. Total usage ",
    " by ",
    ". Average daily usage was ",
    ", compared with ",
    " previously. Weather attribution and bill calculations are not included.",
)

_KEEP_NULLS = {"ignoreNullFields": "false"}

#: Column of an account that all who ask for it share a response of.
_ACCOUNT = "_account"

#: Writes rows under a label and reads them back.
Stage = Callable[[DataFrame, str], DataFrame]

#: Puts columns made of ``response_json`` in its place and keeps the others.
Read = Callable[[DataFrame], DataFrame]


def _string_field(document: Column, name: str) -> Column:
    """A top-level field if it is a JSON string, else null."""
    value = F.try_variant_get(document, f"$.{name}", "variant")
    is_string = F.schema_of_variant(value) == F.lit("STRING")
    return F.when(is_string, F.try_variant_get(document, f"$.{name}", "string"))


def parse(requests: DataFrame) -> DataFrame:
    """Split request documents into operation, account and month.

    The fields leave through a generator of one element. Filters on them cannot be
    pushed below it, where every mention of a field would parse the text again.
    """
    document = F.col("_document")
    fields = F.struct(
        F.coalesce(F.schema_of_variant(document).startswith("OBJECT"), F.lit(False)).alias(
            "is_object"
        ),
        *[_string_field(document, n).alias(n) for n in ("operation", "account_id", "month")],
    )
    return requests.withColumn("_document", F.try_parse_json("request_json")).select(
        *requests.columns, F.inline(F.array(fields))
    )


def _needs_month() -> Column:
    return F.col("operation").isin("investigate_usage", "explain_usage")


def _first_failure(rules: list[tuple[Column, tuple[str, str]]]) -> Column:
    """Code and message of the first rule that fires, else null."""
    failures = [
        F.when(
            F.coalesce(fires, F.lit(False)),
            F.struct(F.lit(code).alias("code"), F.lit(message).alias("message")),
        )
        for fires, (code, message) in rules
    ]
    return F.coalesce(*failures)


def validate(parsed: DataFrame) -> DataFrame:
    """Add ``error`` (code, message) for requests that are wrong by themselves."""
    operation, account, month = F.col("operation"), F.col("account_id"), F.col("month")
    rules = [
        (~F.col("is_object"), MALFORMED),
        (operation.isNull() | ~operation.isin(OPERATIONS), UNSUPPORTED),
        (
            (operation != "list_accounts") & (account.isNull() | ~account.rlike(r"\S")),
            MISSING_ACCOUNT,
        ),
        (
            _needs_month() & (month.isNull() | ~month.rlike(r"^\d{4}-(0[1-9]|1[0-2])\z")),
            BAD_MONTH,
        ),
    ]
    return parsed.withColumn("error", _first_failure(rules))


def _not_finite(df: DataFrame) -> Column:
    """Does the row hold a number that JSON cannot carry?"""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    tests = [
        F.isnan(c) | (F.abs(F.col(c)) == F.lit(float("inf"))) for c in map(conform.quoted, doubles)
    ]
    return F.coalesce(reduce(or_, tests, F.lit(False)), F.lit(False))


def _nested(df: DataFrame, period: str, name: str) -> DataFrame:
    """Rows of each building as an array sorted by period."""
    ordered = [period, *[c for c in df.columns if c != period]]
    return df.groupBy("building_id").agg(
        F.sort_array(F.collect_list(F.struct(*ordered))).alias(name),
        F.bool_or(_not_finite(df)).alias(f"_{name}_bad"),
    )


def _nested_days(daily: DataFrame) -> DataFrame:
    return _nested(daily, "usage_date", "daily_usage")


def _nested_months(monthly: DataFrame) -> DataFrame:
    return _nested(monthly, "usage_month", "monthly_usage")


def nest_usage(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """Daily and monthly rows of each building as sorted arrays.

    The arrays hold one element per day and month of a building, which the
    calendar bounds.
    """
    return _nested_days(daily).join(_nested_months(monthly), "building_id", "full_outer")


def asked_details(
    wanted: DataFrame, snapshot: dict[str, DataFrame], stage: Stage = stage
) -> DataFrame:
    """``account_details`` of the accounts in ``wanted`` (column account_id) alone.

    The accounts found are written, and joined to the usage by building and by the folder
    that holds it, so that Spark can leave out the folders of all others.
    """
    published = snapshot["accounts"]
    wanted = wanted.groupBy("account_id").agg(F.count("*").alias("_requests"))
    # The condition holds for every row; it tells Spark that the list is a selection,
    # for which leaving out folders pays.
    asked = stage(published.join(wanted, "account_id"), "asked-accounts").filter("_requests > 0")

    def of_asked(usage: DataFrame) -> DataFrame:
        on = [c for c in ("building_id", BUCKET) if c in usage.columns and c in published.columns]
        return usage.join(asked.select(*on), on, "left_semi").select(*usage.columns).drop(BUCKET)

    return account_details(
        asked.select(*published.columns).drop(BUCKET),
        of_asked(snapshot["daily_usage"]),
        of_asked(snapshot["monthly_usage"]),
    )


def account_details(accounts: DataFrame, daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """Per account: its row and its nested usage.

    Days and months are joined to the account one after the other: a full outer join of
    the two would forget that they lie by building, and shuffle the arrays again.
    """
    account = F.struct(*accounts.columns).alias("account")
    details = (
        accounts.select("building_id", "account_id", account, _not_finite(accounts).alias("_bad"))
        .join(_nested_days(daily), "building_id", "left")
        .join(_nested_months(monthly), "building_id", "left")
    )
    arrays = ["daily_usage", "monthly_usage"]
    no_rows = {n: F.coalesce(n, F.array().cast(details.schema[n].dataType)) for n in arrays}
    bad = reduce(or_, (F.coalesce(f"_{n}_bad", F.lit(False)) for n in arrays), F.col("_bad"))
    return (
        details.withColumns(no_rows)
        .withColumn("_bad", bad)
        .drop(*(f"_{n}_bad" for n in arrays))
    )


def find_comparison(
    requests: DataFrame, investigations: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Attach the comparison row of each request's account and month.

    ``hot``: much-requested accounts, where they are known already.
    """
    shown = [c for c in investigations.columns if c not in ("account_id", BUCKET)]
    rows = investigations.select(
        "account_id",
        periods.month_key("usage_month").alias("month"),
        F.struct(*shown).alias("comparison"),
        _not_finite(investigations).alias("_comparison_bad"),
    )
    return skewed_join(requests, rows, ["account_id", "month"], "left", hot).withColumn(
        "comparison_available",
        F.col("comparison").isNotNull() & F.col("comparison.previous_month").isNotNull(),
    )


def explanation(comparison: Column, available: Column) -> Column:
    """Summary text of a comparison and where it comes from."""

    def kwh(name: str) -> Column:
        return F.concat(text.fixed(comparison[name]), F.lit(" kWh"))

    change = comparison["electricity_change_kwh"]
    lead, gap = map(F.lit, ALONE)
    alone = F.concat(lead, kwh("electricity_kwh"), gap)
    amounts = [
        kwh("electricity_kwh"),
        kwh("previous_electricity_kwh"),
        F.when(change >= 0, F.lit("increased")).otherwise(F.lit("decreased")),
        F.concat(text.fixed(F.abs(change)), F.lit(" kWh")),
        kwh("average_daily_kwh"),
        kwh("previous_average_daily_kwh"),
    ]
    sentences = [F.lit(part) for part in COMPARED]
    compared = F.concat(sentences[0], *[c for pair in zip(amounts, sentences[1:]) for c in pair])
    return F.struct(
        F.when(available, compared).otherwise(alone).alias("text"),
        F.when(available, F.lit("fallback")).otherwise(F.lit("no_comparison")).alias("source"),
        F.lit(None).cast("string").alias("model"),
    )


def described(metadata: DataFrame) -> Column:
    """The snapshot's one-row description, read once."""
    shown = metadata.drop("snapshot_id", "schema_version")
    row = shown.first()
    if row is None:
        return F.lit(None).cast(shown.schema)
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in shown.schema.fields])


def _result(operation: str, metadata: Column, data: Column) -> Column:
    """The document of one result."""
    result = F.struct(F.lit(operation).alias("operation"), metadata.alias("metadata"), data.alias("data"))
    return F.to_json(result, _KEEP_NULLS)


def _comparison_data(*extra: Column) -> Column:
    return F.struct(
        "account_id",
        "comparison_available",
        "comparison",
        F.lit(EXPLANATION_SCOPE).alias("explanation_scope"),
        *extra,
    )


def evidence(metadata: DataFrame) -> Column:
    """JSON document that a text model may use as its only evidence."""
    return _result("explain_usage", described(metadata), _comparison_data())


def _listing(accounts: DataFrame, listing_at: str) -> Column:
    """The account listing at any size: where the published rows lie, and how many."""
    count = accounts.agg(F.count("*").alias("n")).scalar()
    return F.struct(F.lit(listing_at).alias("accounts_at"), count.alias("account_count"))


def _looks_up() -> Column:
    """Does the request name an account that is to be found?"""
    return F.coalesce(F.col("error").isNull() & (F.col("operation") != "list_accounts"), F.lit(False))


def locate(
    checked: DataFrame, accounts: DataFrame, investigations: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Validated requests with account, comparison row and final ``error``.

    ``hot``: much-requested accounts, where they are known already.
    """
    # Requests that look nothing up stay out of the joins.
    asking, rest = checked.filter(_looks_up()), checked.filter(~_looks_up())
    if hot is None:
        hot = hot_keys(asking, ["account_id"])
    found = find_comparison(conform.lookup_accounts(asking, accounts, hot), investigations, hot)
    found = found.unionByName(rest, allowMissingColumns=True)
    by_month = F.col("error").isNull() & _needs_month()
    rules = [
        (_looks_up() & ~F.col("account_known"), UNKNOWN_ACCOUNT),
        # The calendar has no year 0.
        (by_month & F.col("month").startswith("0000"), NO_SUCH_MONTH),
        (by_month & F.col("comparison").isNull(), NO_DATA),
        (by_month & F.col("_comparison_bad"), NOT_JSON),
    ]
    return found.withColumn("error", F.coalesce("error", _first_failure(rules)))


def answer(
    requests: DataFrame,
    snapshot: dict[str, DataFrame],
    listing_at: str,
    stage: Stage = stage,
    read: Read | None = None,
) -> DataFrame:
    """Responses to all requests: ``ok``, ``error_code`` and ``response_json``.

    ``listing_at`` is where the published account rows lie; a listing names that folder
    and the number of accounts.

    ``read`` turns ``response_json`` into columns of its own, for callers that want parts of
    the responses. All who ask for the details of an account get the same text, which is
    long; it is made, written and read once, and its rows joined to their requests.

    Requests are parsed once and written. The result reads what ``stage`` wrote;
    ``respond`` also deletes that.
    """
    metadata = described(snapshot["metadata"])
    read = read or (lambda answered: answered)
    checked = stage(validate(parse(requests)), "parsed-requests")
    hot = stage(hot_keys(checked.filter(_looks_up()), ["account_id"]), "hot-accounts")

    of_account = F.coalesce(
        F.col("error").isNull() & (F.col("operation") == "account_details"), F.lit(False)
    )
    located = locate(checked.filter(~of_account), snapshot["accounts"], snapshot["investigations"], hot)
    told = explanation(F.col("comparison"), F.col("comparison_available")).alias("explanation")
    operation = F.col("operation")
    result = (
        F.when(operation == "list_accounts", _result("list_accounts", metadata, _listing(snapshot["accounts"], listing_at)))
        .when(operation == "explain_usage", _result("explain_usage", metadata, _comparison_data(told)))
        .otherwise(_result("investigate_usage", metadata, _comparison_data()))
    )
    own = read(located.select(*requests.columns, *_response(result)))

    # The requests are written rows, so their numbers are the same on every attempt.
    asking = checked.filter(of_account).select(*requests.columns, F.col("account_id").alias(_ACCOUNT))
    shared = stage(
        read(_account_answers(asking, snapshot, metadata, stage)), "account-answers"
    )
    joined = skewed_join(
        asking,
        shared,
        [_ACCOUNT],
        "inner",
        hot.withColumnRenamed("account_id", _ACCOUNT),
        F.monotonically_increasing_id(),
    )
    return own.unionByName(joined.drop(_ACCOUNT))


def respond(
    requests: DataFrame, snapshot: dict[str, DataFrame], listing_at: str, path: str
) -> None:
    """Answer a batch into parquet files at ``path``; nothing staged is left behind."""
    with Staging(requests.sparkSession) as staging:
        answer(requests, snapshot, listing_at, staging).write.parquet(path)


def _response(result: Column) -> list[Column]:
    """The response columns of rows with ``error`` and, if there is none, a result document."""
    right = F.col("error").isNull()
    failed = F.to_json(F.struct(F.lit(False).alias("ok"), "error"))
    full = F.concat(F.lit('{"ok":true,"result":'), result, F.lit("}"))
    return [
        right.alias("ok"),
        F.col("error.code").alias("error_code"),
        F.when(right, full).otherwise(failed).alias("response_json"),
    ]


def _account_answers(
    asking: DataFrame, snapshot: dict[str, DataFrame], metadata: Column, stage: Stage
) -> DataFrame:
    """The one response to all details requests of an account, known or not."""
    wanted = asking.select(F.col(_ACCOUNT).alias("account_id"))
    data = F.struct("account", "daily_usage", "monthly_usage")
    found = (
        asked_details(wanted, snapshot, stage)
        .withColumn("error", _first_failure([(F.col("_bad"), NOT_JSON)]))
        .select(
            F.col("account_id").alias(_ACCOUNT),
            *_response(_result("account_details", metadata, data)),
        )
    )
    unknown = (
        wanted.distinct()
        .join(snapshot["accounts"].select("account_id"), "account_id", "left_anti")
        .withColumn("error", _first_failure([(F.lit(True), UNKNOWN_ACCOUNT)]))
        .select(F.col("account_id").alias(_ACCOUNT), *_response(F.lit(None).cast("string")))
    )
    return found.unionByName(unknown)
