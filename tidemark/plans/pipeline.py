"""The pipeline: landing folders to reports' tables, in batch or as a chain of streams."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import contracts as C
from tidemark.functions import event_day
from tidemark.operators.anomalies import app_anomalies_daily, txn_anomalies_daily
from tidemark.operators.quality import quality_log, union_logs
from tidemark.operators.rules import mark_failures
from tidemark.plans.gold import BUSINESS_RULES, gold_accounts, gold_transaction_features, with_income_ratio
from tidemark.plans.metrics import Bronze, daily_metrics_in_one_pass
from tidemark.plans.silver import checked, technical_rules
from tidemark.session import WRITE_SETTINGS, settings, stream_settings, together
from tidemark.sources.landing import bronze
from tidemark.sources.ledger import FileLedger
from tidemark.sources.tables import CLEAN, OUTCOME, TableStore, register_table, with_outcome
from tidemark.streaming.delta import DeltaJoin, delta_join
from tidemark.streaming.sinks import BATCH, count_rules


BATCH_MODE, STREAM_MODE = "batch", "stream"

# Tables that may have no row, thus no file to take the schema from.
_SCHEMAS = {
    "gold_app_ml_anomaly_agg": "app_anomalies_count bigint, date date",
    "gold_txn_ml_anomaly_agg": "txn_anomalies_count bigint, date date",
}

# Tables without folders by day.
_UNDATED = ("gold_accounts",)


@dataclass(frozen=True)
class Config:
    """``root`` must be shared storage on a cluster: it holds tables and checkpoints.

    Each run mode has a folder of its own below it, and readers see the one that ended last.
    """

    landing: str
    root: str
    as_of: str | None = None            # now, where not given
    freshness_days: int = C.FRESHNESS_DAYS
    freshness_hours: float | None = None
    app_threshold: float = C.APP_ANOMALY_RATIO
    txn_threshold: float = C.TXN_ANOMALY_RATIO
    amount_cap: float = C.AMOUNT_TO_LIMIT_CAP
    max_files: int | None = None        # per micro-batch
    load_ts: str | None = None          # SQL for the ingest stamp, for repeatable runs


@dataclass
class Pipeline:
    spark: SparkSession
    config: Config
    queries: dict[str, StreamingQuery] = field(default_factory=dict)

    def __post_init__(self):
        if self.spark.conf.get("spark.sql.session.timeZone") != "UTC":
            raise ValueError("the session time zone must be UTC: day windows and dates would differ")
        self._current = TableStore(self.spark, self.config.root)
        self.ledger = FileLedger(self.spark, self._current.path("landed_files"))
        self._use(self._finished_mode() or BATCH_MODE)
        self.as_of = self.config.as_of or datetime.now(timezone.utc).replace(tzinfo=None)

    # --- run modes ---

    def _finished_mode(self) -> str | None:
        if not self._current.exists("mode"):
            return None
        return self._current.read("mode").agg(F.max_by("mode", "ended")).first()[0]

    def _use(self, mode: str) -> None:
        # the runs of a stream add files side by side, and later ones may have more columns
        self.store = TableStore(self.spark, f"{self.config.root.rstrip('/')}/{mode}", merge=mode == STREAM_MODE)

    @contextmanager
    def _mode(self, mode: str):
        """Work on the tables of one mode; readers turn to them only once the run has ended.

        A stream's checkpoints and sink logs belong to the files they name, so a rebuild
        must not replace those. Apart from each other, either mode can follow the other, and
        a run that breaks off leaves the tables of the other mode in use.
        """
        before = self.store
        self._use(mode)
        try:
            with settings(self.spark, WRITE_SETTINGS):
                yield
        except BaseException:
            self.store = before
            raise
        if self._finished_mode() != mode:
            # appended, so that there is an entry at any moment
            entry = self.spark.range(1).select(F.lit(mode).alias("mode"), F.current_timestamp().alias("ended"))
            entry.write.mode("append").parquet(self._current.path("mode"))

    # --- shared pieces ---

    def _rules(self, entity: str):
        return technical_rules(entity, self.as_of, self.config.freshness_days, self.config.freshness_hours)

    def _bronze(self, entity: str, streaming: bool) -> DataFrame:
        # A file's own time stays the same when tables are rebuilt; the clock would not.
        stamp = F.col("_metadata.file_modification_time") if self.config.load_ts is None else F.expr(
            self.config.load_ts.format(event_time=C.event_time(entity))
        )
        raw = bronze(self.spark, self.config.landing, entity, streaming, self.config.max_files, stamp, self.ledger)
        return raw.withColumn("date", event_day(C.event_time(entity)))

    @staticmethod
    def _gold_apps(silver_apps: DataFrame) -> DataFrame:
        return with_outcome(with_income_ratio(mark_failures(silver_apps, BUSINESS_RULES)))

    def _gold_txn(self, transactions: DataFrame, accounts: DataFrame) -> DataFrame:
        joined = gold_transaction_features(transactions, accounts, cap=self.config.amount_cap)
        return joined.withColumn("date", event_day("timestamp"))

    def table(self, name: str) -> DataFrame:
        """Accepted rows of a table."""
        df = self.store.read(name, _SCHEMAS.get(name)).drop(BATCH)
        return self.store.clean(df) if OUTCOME in df.columns else df

    def rejected(self, name: str) -> DataFrame:
        """Refused rows of a silver table or of gold_applications, with the rules they broke."""
        return self.store.rejected(self.store.read(name))

    def register_views(self) -> None:
        """Accepted rows of every table as temporary views under their SQL names."""
        for view, (name, _, _) in C.VIEWS.items():
            self.table(name).createOrReplaceTempView(view)

    def publish(self, view: str, database: str = "default") -> None:
        """Put a table under its SQL name into the catalog, with remark and quality tier; no data is written.

        The catalog table lies over the stored folder, of checked tables over that of the
        accepted rows. Publish again after a run that added days or columns, or ran in the other mode.
        """
        name, tier, remark = C.VIEWS[view]
        stored = self.store.read(name, _SCHEMAS.get(name))
        folder = self.store.path(name) + (f"/{OUTCOME}={CLEAN}" if OUTCOME in stored.columns else "")
        layout = [c for c in (BATCH, "date") if c in stored.columns and (c != "date" or name not in _UNDATED)]
        columns = (self.store.clean(stored) if OUTCOME in stored.columns else stored).schema
        register_table(self.spark, f"{database}.{view}", folder, columns, layout, remark, {"quality": tier})

    # --- runs ---

    def run_batch(self) -> None:
        """Rebuild every table from all landed files."""
        with self._mode(BATCH_MODE):
            self._rebuild()

    def _rebuild(self) -> None:
        write, read = self.store.write, self.table
        landed = {e: self._bronze(e, False) for e in C.ENTITIES}  # one after the other: all write to the ledger

        def bronze_and_silver(entity: str) -> None:
            write(landed[entity], f"bronze_{entity}", ("date",))
            rows = checked(entity, self.store.read(f"bronze_{entity}"), self._rules(entity))
            write(with_outcome(rows), f"silver_{entity}", (OUTCOME, "date"))

        def applications_and_accounts() -> None:
            write(self._gold_apps(read("silver_applications")), "gold_applications", (OUTCOME, "date"))
            write(gold_accounts(read("silver_accounts"), read("gold_applications")), "gold_accounts")

        def features() -> None:
            joined = self._gold_txn(read("silver_transactions"), read("silver_accounts"))
            write(joined, "gold_transaction_features", ("date",), balance=True)

        together(bronze_and_silver, C.ENTITIES)
        together(lambda step: step(), (features, applications_and_accounts))
        self.refresh_metrics()

    def run_stream(self) -> None:
        """Take in what has landed since the last run, table by table, then refresh the days it changed.

        Each table is a query with a checkpoint of its own and ends when its input is used
        up, so an upstream table is complete before the next one reads it. Tables that do not
        read each other are taken in at once.
        """
        with self._mode(STREAM_MODE):
            with settings(self.spark, stream_settings(self.spark)):
                self._take_in()
            self.refresh_metrics(only=self.stale_days())

    def _take_in(self) -> None:
        landed = {f"bronze_{e}": self._bronze(e, True) for e in C.ENTITIES}
        self._finish({name: self.store.start(df, name, ("date",)) for name, df in landed.items()})
        rows = {}
        for entity in C.ENTITIES:
            name = f"bronze_{entity}"
            raw = self.store.read_stream(name, landed[name].schema, self.config.max_files)
            counted = count_rules(raw, self._rules(entity), f"silver_{entity}")
            rows[f"silver_{entity}"] = with_outcome(checked(entity, counted, self._rules(entity)))
        self._finish({name: self._start_checked(df, name) for name, df in rows.items()})
        clean = {name.removeprefix("silver_"): self._clean_stream(df, name) for name, df in rows.items()}
        apps = self._gold_apps(clean["applications"])
        first = {"gold_transaction_features": self._start_join("gold_transaction_features", clean)}
        self._finish(first | {"gold_applications": self._start_checked(apps, "gold_applications")})
        clean["gold_applications"] = self._clean_stream(apps, "gold_applications")
        self._finish({"gold_accounts": self._start_join("gold_accounts", clean)})

    def _start_checked(self, df: DataFrame, name: str) -> StreamingQuery:
        return self.store.start(df, name, (OUTCOME, "date"))

    def _clean_stream(self, df: DataFrame, name: str) -> DataFrame:
        return self.store.clean(self.store.read_stream(name, df.schema, self.config.max_files))

    def _start_join(self, name: str, clean: dict[str, DataFrame]) -> StreamingQuery:
        left, right, columns, key, join = self._joins()[name]
        sides = [clean[side].select(*wanted) for side, wanted in zip((left, right), columns)]
        places = self.store.path(name), self.store.joined(name), self.store.checkpoint(name)
        return delta_join(*sides, key, join, *places, name, () if name in _UNDATED else ("date",))

    def _joins(self) -> dict[str, tuple]:
        """Left and right table, the columns taken of each, key and join of the two gold joins."""
        account = "account_id", "app_id", "approved_limit", "interest_rate", "account_open_timestamp"
        application = "app_id", "applicant_age", "annual_income", "req_credit_limit", "application_status"
        transaction = "txn_id", "account_id", "amount", "timestamp", "location"
        limit = "account_id", "approved_limit", "account_open_timestamp"
        return {
            "gold_accounts": ("accounts", "gold_applications", (account, application), "app_id", gold_accounts),
            "gold_transaction_features": ("transactions", "accounts", (transaction, limit), "account_id", self._gold_txn),
        }

    def waiting(self, name: str) -> DataFrame:
        """Rows of a joined gold table's left side that wait for their other side.

        Accounts without an application among the valid ones, transactions without an account. The
        stream tries them again whenever their key comes in; after a rebuild they are found anew.
        """
        left, right, columns, key, join = self._joins()[name]
        right = right if right == "gold_applications" else f"silver_{right}"
        sides = [self.table(t).select(*wanted) for t, wanted in zip((f"silver_{left}", right), columns)]
        if self.store.merge:  # a stream: what it has taken in so far
            return DeltaJoin(self.spark, self.store.joined(name), key, join, *(df.schema for df in sides)).waiting()
        return sides[0].join(sides[1].select(key), key, "left_anti")

    def _finish(self, queries: dict[str, StreamingQuery]) -> None:
        """Wait for all of ``queries``, then raise the first error there was: none is left running."""
        self.queries |= queries
        errors = []
        for query in queries.values():
            try:
                query.awaitTermination()
            except StreamingQueryException as error:
                errors.append(error)
        if errors:
            raise errors[0]

    def stale_days(self) -> list[date | None] | None:
        """Event days with rows that log and metrics have not seen; None where neither exists yet.

        Tables only grow, so a day is stale when its row counts differ from those recorded
        at the last refresh, whatever became of the runs in between. Counting by partition
        reads parquet footers only. At most one value per day comes back.
        """
        if not (self.store.exists("quality_log") and self.store.exists("gold_daily_metrics")):
            return None

        def counted(table: str) -> DataFrame:
            return self.store.read(table).groupBy("date").agg(F.count(F.lit(1)).alias("rows")).selectExpr(
                "date", f"'{table}' AS table_name", "rows"
            )

        features = "gold_transaction_features"
        now = reduce(DataFrame.unionAll, [counted(f"silver_{e}") for e in C.ENTITIES])
        now = now.unionAll(counted(features).filter("date IS NOT NULL"))
        log = self.store.read("quality_log").filter("status = 'checked' AND table_name <> 'gold_applications'")
        seen = log.groupBy("date", "table_name").agg(F.max("checked_rows").alias("rows")).unionAll(
            self.store.read("gold_daily_metrics").filter("total_transactions > 0").selectExpr(
                "date", f"'{features}' AS table_name", "total_transactions AS rows"
            )
        )
        both = now.withColumn("now", F.col("rows")).unionByName(
            seen.withColumn("seen", F.col("rows")), allowMissingColumns=True
        )
        changed = both.groupBy("date", "table_name").agg(F.max("now").alias("now"), F.max("seen").alias("seen"))
        return [r[0] for r in changed.filter("NOT now <=> seen").select("date").distinct().collect()]

    def refresh_metrics(self, since: str | None = None, only: list[date | None] | None = None) -> None:
        """Recompute quality log, anomaly tables and daily metrics: all days, those from ``since`` on, or ``only`` some.

        Log and metrics read the marks the checked tables carry, so no rule runs a second time
        and few columns are scanned. The anomaly tables count the stored rows of the same days,
        the open day and late rows included, so they agree with the metrics in either mode. Tables are laid out by event day: a choice of days prunes every
        scan to them and replaces only their partitions. Undated rows are always included.
        """
        if only is not None and not only:
            return
        undated = F.col("date").isNull()

        def days(df: DataFrame) -> DataFrame:
            if since is not None:
                df = df.filter((F.col("date") >= F.lit(since).cast("date")) | undated)
            if only is not None:
                df = df.filter(F.col("date").isin([d for d in only if d is not None]) | undated)
            return df.drop("date")

        marked = Bronze(*(days(self.store.read(f"silver_{e}")) for e in C.ENTITIES))
        business = days(self.store.read("gold_applications"))
        logs = [quality_log(getattr(marked, e), self._rules(e), f"silver_{e}", C.event_time(e)) for e in C.ENTITIES]
        logs.append(quality_log(business, BUSINESS_RULES, "gold_applications"))
        refresh = since is not None or only is not None
        apps, transactions = days(self.table("gold_applications")), days(self.table("gold_transaction_features"))
        thresholds = self.config.app_threshold, self.config.txn_threshold
        metrics = daily_metrics_in_one_pass(marked, transactions, {e: self._rules(e) for e in C.ENTITIES}, business, *thresholds)
        flagged = app_anomalies_daily(apps, thresholds[0]), txn_anomalies_daily(transactions, thresholds[1])
        for name, counts in zip(_SCHEMAS, flagged):
            self.store.write(counts, name, ("date",), refresh, balance=True)
        self.store.write(metrics, "gold_daily_metrics", ("date",), refresh, balance=True)
        # the log comes last: a stop in between, as by a fail rule, leaves the days stale
        self.store.write(union_logs(logs), "quality_log", ("date",), refresh, balance=True)
