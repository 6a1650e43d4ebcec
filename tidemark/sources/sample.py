"""The four funnel inputs as views over the supplied sample tables.

All rows of ``events``, ``orders`` and ``lineitem`` are used. Only whole-number and date
arithmetic derives values, so any SQL engine gets the same rows. The mapping plants
rows that break rules: unknown event types, devices and places, missing and minor ages,
impossible limits, duplicate applications, closed limits and odd interest rates.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.landing import landed_counts

AS_OF = "2024-01-30 12:00:00"
REPLAY_DAYS = 60                # a freshness bound before the first day: keeps all days

_START = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"
_BATCH = "(o_orderkey div 10)"  # ten neighbouring orders share day, age and faults
_APPLIED = f"timestampadd(MINUTE, int({_BATCH} % 30 * 1440 + {_BATCH} % 1380), {_START})"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def load_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table as a file stream; the glob fits a single file as well as a folder."""
    schema = load(spark, sf_dir, table).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{table}.parquet*")


def visits_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "string(user_id) AS visitor_id",
        "CASE event_type WHEN 'view' THEN 'landing' WHEN 'click' THEN 'scroll' WHEN 'purchase' THEN 'apply_click' "
        "WHEN 'signup' THEN 'view_pricing' ELSE event_type END AS event_type",
        "CASE WHEN event_id % 13 <> 0 THEN 'CMP' || string(event_id % 100) END AS campaign_id",
        "CASE WHEN event_id % 25 = 0 THEN 'kiosk' ELSE elt(int(event_id % 3) + 1, 'mobile', 'desktop', 'tablet') END AS device_type",
        "elt(int(user_id % 5) + 1, 'USA', 'UK', 'IND', 'CA', 'FR') AS geo",
        "ts AS timestamp",
        "value AS session_duration",
        "timestampadd(HOUR, int(event_id % 9), ts) AS _load_timestamp",
    )


def visits_from_orders(orders: DataFrame) -> DataFrame:
    """The visit each application began with, a few minutes before it."""
    timed = orders.withColumn("timestamp", F.expr(f"timestampadd(MINUTE, int(-1 - {_BATCH} % 14), {_APPLIED})"))
    return timed.selectExpr(
        "string(o_custkey) AS visitor_id",
        "'apply_click' AS event_type",
        "CASE WHEN o_orderkey % 13 <> 0 THEN 'CMP' || string(o_orderkey % 100) END AS campaign_id",
        "elt(int(o_orderkey % 3) + 1, 'mobile', 'desktop', 'tablet') AS device_type",
        "elt(int(o_custkey % 4) + 1, 'USA', 'UK', 'IND', 'CA') AS geo",
        "timestamp",
        "double(30) AS session_duration",
        "timestampadd(HOUR, int(o_orderkey % 9), timestamp) AS _load_timestamp",
    )


def applications(orders: DataFrame) -> DataFrame:
    """One application per order; every 37th batch of orders is sent twice."""
    sent = orders.withColumn("sent", F.expr(f"explode(sequence(1, IF({_BATCH} % 37 = 0, 2, 1)))"))
    timed = sent.withColumn("timestamp", F.expr(_APPLIED))
    return timed.selectExpr(
        "string(o_orderkey) AS app_id",
        "string(o_custkey) AS visitor_id",
        f"CASE WHEN {_BATCH} % 97 <> 0 THEN 10 + {_BATCH} % 60 END AS applicant_age",
        "o_totalprice AS annual_income",
        f"CASE WHEN {_BATCH} % 41 = 0 THEN 'retired' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'salaried' "
        "WHEN o_orderpriority = '5-LOW' THEN 'unemployed' ELSE 'self-employed' END AS employment_status",
        f"o_totalprice * CASE WHEN {_BATCH} % 19 = 0 THEN 1.75D WHEN {_BATCH} % 23 = 0 THEN 0.75D ELSE 0.125D END AS req_credit_limit",
        "timestamp",
        "CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'submitted' ELSE 'rejected' END AS application_status",
        f"timestampadd(HOUR, int({_BATCH} % 9), timestamp) AS _load_timestamp",
    )


def accounts(orders: DataFrame) -> DataFrame:
    """An account per order that was not turned down, submitted ones included."""
    opened = orders.filter("o_orderstatus IN ('F', 'O')").withColumn(
        "account_open_timestamp", F.expr(f"timestampadd(HOUR, int(2 + {_BATCH} % 22), {_APPLIED})")
    )
    return opened.selectExpr(
        "string(1000000 + o_orderkey) AS account_id",
        "string(o_orderkey) AS app_id",
        f"CASE WHEN {_BATCH} % 53 = 0 THEN 0L ELSE bigint(floor(o_totalprice * (1 + {_BATCH} % 4) / 4)) END AS approved_limit",
        f"4.5D + ({_BATCH} % 64) * 0.5D AS interest_rate",
        "account_open_timestamp",
        "'active' AS account_status",
        "timestampadd(HOUR, 1, account_open_timestamp) AS _load_timestamp",
    )


def transactions(lineitem: DataFrame) -> DataFrame:
    timed = lineitem.withColumn(
        "timestamp",
        F.expr(
            "timestampadd(MINUTE, int(((l_orderkey div 10) % 30 + l_linenumber % 3) * 1440 "
            f"+ (l_orderkey + l_partkey) % 1440), {_START})"
        ),
    )
    return timed.selectExpr(
        "string(l_orderkey * 1000000 + l_partkey * 10 + l_linenumber) AS txn_id",
        "string(1000000 + l_orderkey) AS account_id",
        "l_extendedprice AS amount",
        "'5411' AS merchant_cat_code",
        "'N' || string(l_suppkey % 25) AS location",
        "'NA' AS state",
        "'none' AS merchant_city",
        "timestamp",
        "timestampadd(HOUR, l_linenumber, timestamp) AS _load_timestamp",
    )


class Funnel:
    """Bronze inputs of one sample folder, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    @cached_property
    def _orders(self) -> DataFrame:
        return load(self._spark, self._dir, "orders")

    @cached_property
    def visits(self) -> DataFrame:
        return visits_from_events(load(self._spark, self._dir, "events")).unionByName(visits_from_orders(self._orders))

    @cached_property
    def applications(self) -> DataFrame:
        return applications(self._orders)

    @cached_property
    def accounts(self) -> DataFrame:
        return accounts(self._orders)

    @cached_property
    def transactions(self) -> DataFrame:
        return transactions(load(self._spark, self._dir, "lineitem"))

    def items(self) -> list[tuple[str, DataFrame]]:
        return [
            ("visitor_events", self.visits),
            ("applications", self.applications),
            ("accounts", self.accounts),
            ("transactions", self.transactions),
        ]

    def landed(self) -> DataFrame:
        """Row counts of the tables the inputs are made from."""
        return landed_counts(self._spark, {t: f"{self._dir}/{t}.parquet" for t in ("events", "orders", "lineitem")})
