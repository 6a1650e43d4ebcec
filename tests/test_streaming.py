"""Streams: windows and late rows, restart, join state, drift, counters."""

from datetime import date

import pytest
from helpers import ACCOUNTS, TXNS, rows, table, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contracts as C
from tidemark.operators.anomalies import app_anomalies_daily
from tidemark.plans import gold, silver
from tidemark.session import scratch_dir, settings
from tidemark.sources.drift import check_drift, widened
from tidemark.sources.landing import bronze_stream, land
from tidemark.streaming.delta import MAP_CELLS, DeltaJoin, delta_join, key_map, may_match
from tidemark.streaming.late import daily_counts, daily_totals, late_rows
from tidemark.streaming.sinks import count_rules, latest, observed_totals, per_batch, read_batches, rule_totals

GOLD_APPS = "timestamp timestamp, req_income_ratio double"


def _days(spark, folder, *days):
    """One file per moment, in order of arrival."""
    for i, day in enumerate(days):
        one = spark.createDataFrame([(ts(day), 0.9)], GOLD_APPS).coalesce(1)
        one.write.mode("append").parquet(f"{folder}/in/{i:03d}")


def _daily(spark, folder, mode, delay=C.WATERMARK_DELAY):
    source = (
        spark.readStream.schema(GOLD_APPS).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    )
    query = per_batch(app_anomalies_daily(source, delay=delay), f"{folder}/out", f"{folder}/checkpoint", mode=mode)
    query.awaitTermination()
    return query


def _out(spark, folder):
    return [d.day for d, n in rows(latest(spark, f"{folder}/out", "date"))]


def test_window_closes_with_the_watermark(spark, tmp_path):
    _days(spark, tmp_path, "2024-01-01 10:00:00", "2024-01-03 10:00:00")
    _daily(spark, tmp_path, "append")
    assert _out(spark, tmp_path) == [1]
    other = tmp_path / "update"
    _days(spark, other, "2024-01-01 10:00:00", "2024-01-03 10:00:00")
    _daily(spark, other, "update")
    assert _out(spark, other) == [1, 3]


def test_one_batch_late_counts(spark, tmp_path):
    _days(spark, tmp_path, *(f"2024-01-0{d} 10:00:00" for d in (1, 5, 2, 9)))
    _daily(spark, tmp_path, "append")
    assert _out(spark, tmp_path) == [1, 2, 5]


def test_truly_late_is_dropped_unless_the_delay_covers_it(spark, tmp_path):
    days = [f"2024-01-0{d} 10:00:00" for d in (1, 5, 6, 2, 9)]
    _days(spark, tmp_path, *days)
    query = _daily(spark, tmp_path, "append")
    assert _out(spark, tmp_path) == [1, 5, 6]
    assert sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators) == 1
    patient = tmp_path / "patient"
    _days(spark, patient, *days)
    _daily(spark, patient, "update", delay="10 days")
    assert _out(spark, patient) == [1, 2, 5, 6, 9]


def test_a_derived_day_key_cannot_append(spark, tmp_path):
    _days(spark, tmp_path, "2024-01-01 10:00:00")
    source = spark.readStream.schema(GOLD_APPS).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    counted = source.withWatermark("timestamp", "2 hours").groupBy(F.to_date("timestamp")).count()
    with pytest.raises(Exception, match="(?i)append"):
        counted.writeStream.format("noop").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()


def test_restart_counts_each_row_once(spark, tmp_path):
    _days(spark, tmp_path, "2024-01-01 10:00:00", "2024-01-01 11:00:00")
    _daily(spark, tmp_path, "update")
    spark.createDataFrame([(ts("2024-01-01 12:00:00"), 0.9)], GOLD_APPS).coalesce(1).write.parquet(f"{tmp_path}/in/900")
    _daily(spark, tmp_path, "update")
    assert rows(latest(spark, f"{tmp_path}/out", "date")) == [(date(2024, 1, 1), 3)]
    _daily(spark, tmp_path, "update")
    assert rows(latest(spark, f"{tmp_path}/out", "date")) == [(date(2024, 1, 1), 3)]


def _stage(spark, folder, kind, name, *changes):
    df = table(spark, kind, *changes)
    df.coalesce(1).write.parquet(f"{folder}/{kind}/{name}")
    return df.schema


def _source(spark, folder, kind, schema):
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/{kind}")


def test_static_side_is_seen_only_when_read_again(spark, tmp_path):
    schema = _stage(spark, tmp_path, "accounts", "0", {"app_id": "late"})
    app_schema = _stage(spark, tmp_path, "apps", "0", {"app_id": "early"})

    def apps():
        raw = spark.read.schema(app_schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/apps")
        return gold.gold_applications(silver.silver_applications(raw))

    fixed = apps()
    plain = gold.gold_accounts(silver.silver_accounts(_source(spark, tmp_path, "accounts", schema)), fixed)
    _stage(spark, tmp_path, "apps", "1", {"app_id": "late"})
    per_batch(plain, f"{tmp_path}/plain", f"{tmp_path}/plain-c").awaitTermination()
    assert read_batches(spark, f"{tmp_path}/plain").count() == 0
    stream = silver.silver_accounts(_source(spark, tmp_path, "accounts", schema))
    per_batch(stream, f"{tmp_path}/again", f"{tmp_path}/again-c", lambda batch: gold.gold_accounts(batch, apps())).awaitTermination()
    assert rows(read_batches(spark, f"{tmp_path}/again"), "app_id") == [("late",)]


def _joined(spark, folder):
    """One run of the join over what has landed, file by file."""
    def stream(kind, schema):
        raw = spark.readStream.schema(schema).options(maxFilesPerTrigger=1, recursiveFileLookup=True).parquet(f"{folder}/{kind}")
        return silver.silver_transactions(raw) if kind == "txns" else silver.silver_accounts(raw)

    return delta_join(
        stream("txns", TXNS).drop("tdq_processed_at"), stream("accounts", ACCOUNTS).select("account_id", "approved_limit", "account_open_timestamp"),
        "account_id", gold.gold_transaction_features, f"{folder}/out", f"{folder}/joined", f"{folder}/c")


def _batch_features(spark, folder):
    accounts = spark.read.schema(ACCOUNTS).option("recursiveFileLookup", "true").parquet(f"{folder}/accounts")
    txns = spark.read.schema(TXNS).option("recursiveFileLookup", "true").parquet(f"{folder}/txns")
    return gold.gold_transaction_features(silver.silver_transactions(txns), silver.silver_accounts(accounts))


@pytest.mark.parametrize("late", ["txns", "accounts", None])
def test_stream_join_equals_batch_in_any_order(spark, tmp_path, late):
    """Keys meet within a batch, across batches in either order, twice on either side, and never."""
    for kind in ("txns", "accounts"):
        _stage(spark, tmp_path, kind, "none", {})
    changes = {
        "accounts": [[{"account_id": f"c{i % 3}", "approved_limit": 100 + i}, {"account_id": f"alone{i}"}, {"account_id": None}] for i in range(4)],
        "txns": [[{"txn_id": f"{i}-{j}", "account_id": f"c{j}"} for j in range(7)] + [{"txn_id": f"n{i}", "account_id": None}] for i in range(4)],
    }
    first, second = [k for k in changes if k != late], [late] if late else []
    if late is None:
        first = []
        for i in range(4):
            for kind in changes:
                _stage(spark, tmp_path, kind, str(i), *changes[kind][i])
    for kinds in (first, second):
        for kind in kinds:
            for i, rows_ in enumerate(changes[kind]):
                _stage(spark, tmp_path, kind, str(i), *rows_)
        query = _joined(spark, tmp_path)
        query.awaitTermination()
        assert query.exception() is None
        assert all(not p.stateOperators for p in query.recentProgress)
    got = rows(read_batches(spark, f"{tmp_path}/out"), "txn_id", "approved_limit")
    want = rows(_batch_features(spark, tmp_path), "txn_id", "approved_limit")
    assert got == want and len(want) > 10


def test_a_join_batch_run_again_adds_nothing(spark, tmp_path):
    work = DeltaJoin(spark, f"{tmp_path}/s", "k", lambda a, b: a.join(b, "k"), T.StructType().add("k", "long").add("l", "long"),
                     T.StructType().add("k", "long").add("r", "long"))

    def batch(left, right):
        data = [({"k": k, "l": v}, None, "left") for k, v in left] + [(None, {"k": k, "r": v}, "right") for k, v in right]
        return spark.createDataFrame(data, work.schema)

    def step(n, left, right):
        return rows(work.step(batch(left, right), n), "k", "l", "r")

    assert step(0, [(1, 10), (2, 20), (None, 0)], [(2, 5)]) == [(2, 20, 5)]
    for _ in range(2):
        assert step(1, [(1, 11)], [(1, 6), (2, 7)]) == [(1, 10, 6), (1, 11, 6), (2, 20, 7)]
    assert step(2, [], []) == []
    assert step(3, [(3, 30)], []) == []
    assert rows(work.waiting(), "l") == [(0,), (30,)]
    assert step(4, [], [(3, 8), (3, 9)]) == [(3, 30, 8), (3, 30, 9)]
    assert rows(work.waiting(), "l") == [(0,)]


def test_stored_rows_are_cut_down_before_the_shuffle(spark):
    stored = spark.range(100_000).selectExpr("string(id) AS k")
    new = spark.range(0, 100_000, 1000).selectExpr("string(id) AS k")
    kept = may_match(stored, "k", key_map(new, "k"))
    assert kept.columns == ["k"] and kept.join(new, "k", "left_semi").count() == 100 <= kept.count() < 200
    assert may_match(stored, "k", key_map(new.limit(0), "k")).count() == 0
    few = key_map(spark.range(3_000_000).selectExpr("id AS k"), "k")
    assert few.count() <= MAP_CELLS


def test_rule_counters_ride_along(spark, tmp_path):
    schema = _stage(spark, tmp_path, "apps", "0", {}, {"applicant_age": 101}, {"applicant_age": None, "annual_income": 0.0})
    counted = count_rules(_source(spark, tmp_path, "apps", schema), silver.APPLICATION_RULES, "dq")
    query = per_batch(silver.silver_applications(counted), f"{tmp_path}/out", f"{tmp_path}/c")
    query.awaitTermination()
    totals = observed_totals(query, "dq")
    assert (totals["checked_rows"], totals["tdq_age_numeric_range"], totals["tdq_income_positive"]) == (3, 2, 1)
    assert read_batches(spark, f"{tmp_path}/out").count() == 1


def test_rule_totals_outlast_the_progress_reports(spark, tmp_path):
    """More batches than Spark keeps reports of, one of them run twice."""
    n = 9
    for i in range(n):
        schema = _stage(spark, tmp_path, "apps", str(i), {}, {"applicant_age": 101}, {"applicant_age": None, "annual_income": 0.0})
    source = spark.readStream.schema(schema).options(maxFilesPerTrigger=1, recursiveFileLookup=True).parquet(f"{tmp_path}/apps")
    broken = [True]

    def step(batch):
        if len(list(tmp_path.glob("out/batch_id=*"))) == 4 and broken:
            broken.clear()
            batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id=4")
            raise RuntimeError("lost")
        return silver.silver_applications(batch)

    with settings(spark, {"spark.sql.streaming.numRecentProgressUpdates": "3"}):
        def run():
            query = per_batch(source, f"{tmp_path}/out", f"{tmp_path}/c", step, rules=silver.APPLICATION_RULES)
            query.awaitTermination()
        with pytest.raises(Exception, match="lost"):
            run()
        run()
    totals = dict(rows(rule_totals(spark, f"{tmp_path}/out"), "name", "rows"))
    assert (totals["checked_rows"], totals["tdq_age_numeric_range"], totals["tdq_income_positive"], totals["tdq_app_id_not_null"]) == (3 * n, 2 * n, n, 0)
    assert read_batches(spark, f"{tmp_path}/out").count() == n


def test_new_column_after_restart_with_a_wider_contract(spark, tmp_path):
    old = table(spark, "apps", {"app_id": "old"}).select(*C.contract("applications").names)
    assert land(old, f"{tmp_path}/applications", "hist", "timestamp")
    new = old.withColumn("app_id", F.lit("new")).withColumn("channel", F.lit("web"))

    def take_in(contract):
        stream = check_drift(bronze_stream(spark, f"{tmp_path}/applications", contract, load_ts=F.col("timestamp")), contract)
        per_batch(stream, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()

    take_in(C.contract("applications"))
    land(new, f"{tmp_path}/applications", "20240131_live", "timestamp")
    take_in(widened(C.contract("applications"), new))
    merged = spark.read.option("mergeSchema", "true").parquet(f"{tmp_path}/out")
    assert rows(merged, "app_id", "channel") == [("new", "web"), ("old", None)]


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    with settings(spark, {"spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_a_failed_batch_run_again_leaves_no_doubles(spark, tmp_path):
    schema = _stage(spark, tmp_path, "apps", "0", {"app_id": "1"}, {"app_id": "2"})
    broken = [True]

    def step(batch):
        if broken.pop() if broken else False:
            batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id=0")
            raise RuntimeError("lost after writing")
        return batch

    with pytest.raises(Exception, match="lost after writing"):
        per_batch(_source(spark, tmp_path, "apps", schema), f"{tmp_path}/out", f"{tmp_path}/c", step).awaitTermination()
    per_batch(_source(spark, tmp_path, "apps", schema), f"{tmp_path}/out", f"{tmp_path}/c", step).awaitTermination()
    assert rows(read_batches(spark, f"{tmp_path}/out"), "app_id") == [("1",), ("2",)]


def _counted(spark, folder, *batches, delay="2 hours", name="daily"):
    """Each batch of (moment, ratio) is landed and taken in by a run of its own."""
    for i, batch in enumerate(batches):
        moments = [(ts(m) if m else None, r) for m, r in batch]
        spark.createDataFrame(moments, GOLD_APPS).coalesce(1).write.parquet(f"{folder}/landed/{i:03d}-{name}")
        source = spark.readStream.schema(GOLD_APPS).option("recursiveFileLookup", "true").parquet(f"{folder}/landed")
        daily_counts(source, F.col("req_income_ratio") > 0.6, delay, f"{folder}/{name}", f"{folder}/checkpoint").awaitTermination()
    return f"{folder}/{name}"


def _totals(spark, path, **how):
    return [tuple(r) for r in daily_totals(spark, path, "n", **how).orderBy("date").collect()]


def test_late_rows_are_kept_counted_and_replayed(spark, tmp_path):
    path = _counted(
        spark, tmp_path,
        [("2024-01-01 10:00:00", 0.9), ("2024-01-03 01:00:00", 0.9)],
        [("2024-01-01 11:00:00", 0.9), ("2024-01-01 12:00:00", 0.1), ("2024-01-02 11:00:00", 0.9), (None, 0.9)],
        [("2024-01-03 02:00:00", 0.9)],
    )
    first, second, third = (date(2024, 1, d) for d in (1, 2, 3))
    # the second day ended one hour before the latest row: still open; the first day is closed
    assert _totals(spark, path) == [(None, 1, 0), (first, 2, 1), (second, 1, 0), (third, 2, 0)]
    assert _totals(spark, path, replay=False) == [(None, 1, 0), (first, 1, 1), (second, 1, 0), (third, 2, 0)]
    kept = late_rows(spark, path).collect()
    assert [(r["timestamp"], r["batch_id"]) for r in kept] == [(ts("2024-01-01 11:00:00"), 1)]


def test_rows_that_do_not_count_move_the_bound(spark, tmp_path):
    path = _counted(spark, tmp_path, [("2024-01-09 10:00:00", 0.1)], [("2024-01-01 10:00:00", 0.9)])
    assert _totals(spark, path) == [(date(2024, 1, 1), 1, 1)]


def test_a_longer_delay_leaves_none_late_and_totals_equal_a_batch(spark, tmp_path):
    batches = [[(f"2024-01-{d:02d} {h:02d}:00:00", 0.9)] for d, h in ((9, 1), (2, 2), (5, 3), (2, 23))]
    path = _counted(spark, tmp_path, *batches, delay="10 days")
    assert [n for _, _, n in _totals(spark, path)] == [0, 0, 0] and late_rows(spark, path).count() == 0
    strict = _counted(spark, tmp_path / "strict", *batches)
    apps = spark.createDataFrame([(ts(m), r) for batch in batches for m, r in batch], GOLD_APPS)
    batch = [tuple(r) for r in app_anomalies_daily(apps).orderBy("date").collect()]
    assert [t[:2] for t in _totals(spark, strict)] == batch == [t[:2] for t in _totals(spark, path)]
    assert sum(n for _, _, n in _totals(spark, strict)) == 3 == late_rows(spark, strict).count()


def test_a_batch_run_again_counts_once(spark, tmp_path):
    path = _counted(spark, tmp_path, [("2024-01-09 10:00:00", 0.9)], [("2024-01-01 10:00:00", 0.9)])
    # as after a stop between the sink's write and its commit
    for log in (tmp_path / "checkpoint" / "commits").glob("*1*"):
        log.unlink()
    source = spark.readStream.schema(GOLD_APPS).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/landed")
    daily_counts(source, F.col("req_income_ratio") > 0.6, "2 hours", path, f"{tmp_path}/checkpoint").awaitTermination()
    assert _totals(spark, path) == [(date(2024, 1, 1), 1, 1), (date(2024, 1, 9), 1, 0)]
    assert late_rows(spark, path).count() == 1
