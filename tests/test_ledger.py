"""The ledger of landed files: only new files are opened, schemas and counts come from it."""

import os

import pytest
from helpers import rows, table
from pyspark.sql import functions as F

from tidemark import contracts as C
from tidemark.sources.drift import SchemaDrift
from tidemark.sources.landing import bronze, land
from tidemark.sources.ledger import FileLedger


def _files(folder):
    return sorted(folder.rglob("*.parquet"))


def _spoil(path):
    """Other content of the same size and time: whoever opens the file fails."""
    stat = path.stat()
    path.write_bytes(b"x" * stat.st_size)
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    crc = path.parent / f".{path.name}.crc"
    if crc.exists():
        crc.unlink()


def test_a_second_update_opens_new_files_only(spark, tmp_path):
    ledger = FileLedger(spark, f"{tmp_path}/ledger")
    assert ledger.counts().count() == 0
    apps = table(spark, "apps", {"app_id": "1"}, {"app_id": "2"}).select(*C.contract("applications").names)
    land(apps, f"{tmp_path}/landing/applications", "hist", "timestamp")
    first = _files(tmp_path / "landing")
    assert ledger.update("applications", f"{tmp_path}/landing/applications") == len(first) > 0
    for path in first:
        _spoil(path)
    assert ledger.update("applications", f"{tmp_path}/landing/applications") == 0
    land(apps.limit(1).withColumn("channel", F.lit("web")), f"{tmp_path}/landing/applications", "live", "timestamp")
    new = len(_files(tmp_path / "landing")) - len(first)
    assert ledger.update("applications", f"{tmp_path}/landing/applications") == new
    assert rows(ledger.counts(), "table", "files", "rows") == [("applications", len(first) + new, 3)]
    schema = ledger.schema("applications", C.contract("applications"))
    assert schema.names == [*C.contract("applications").names, "channel"]
    assert FileLedger(spark, f"{tmp_path}/ledger").entries("accounts").count() == 0


def test_a_file_written_anew_counts_once(spark, tmp_path):
    ledger = FileLedger(spark, f"{tmp_path}/ledger")
    folder = tmp_path / "in"
    for n in (5, 8):
        spark.range(n).coalesce(1).write.mode("overwrite").parquet(str(folder))
        one, = _files(folder)
        one.rename(folder / "same.parquet")
        for crc in folder.glob(".*.crc"):
            crc.unlink()
        os.utime(folder / "same.parquet", (n, n))
        assert ledger.update("t", str(folder)) == 1
    assert rows(ledger.counts(), "table", "files", "rows") == [("t", 1, 8)]


def test_empty_files_are_noted(spark, tmp_path):
    spark.range(0).coalesce(1).write.parquet(f"{tmp_path}/in")
    ledger = FileLedger(spark, f"{tmp_path}/ledger")
    assert ledger.update("t", f"{tmp_path}/in") == len(_files(tmp_path / "in"))
    assert ledger.update("t", f"{tmp_path}/in") == 0


def test_a_column_of_two_types_is_an_error(spark, tmp_path):
    apps = table(spark, "apps", {}).select(*C.contract("applications").names)
    ledger = FileLedger(spark, f"{tmp_path}/ledger")
    for part, value in (("hist", F.lit("web")), ("live", F.lit(7))):
        land(apps.withColumn("channel", value), f"{tmp_path}/applications", part, "timestamp")
        ledger.update("applications", f"{tmp_path}/applications")
    with pytest.raises(SchemaDrift, match="applications.channel landed as"):
        bronze(spark, str(tmp_path), "applications", ledger=ledger)


def test_bronze_is_the_same_with_and_without_a_ledger(spark, tmp_path):
    apps = table(spark, "apps", {"app_id": "1"}).select(*C.contract("applications").names)
    land(apps, f"{tmp_path}/applications", "hist", "timestamp")
    land(apps.withColumn("zone", F.lit("z")).withColumn("channel", F.lit("web")), f"{tmp_path}/applications", "live", "timestamp")
    plain = bronze(spark, str(tmp_path), "applications", load_ts=F.col("timestamp"))
    noted = bronze(spark, str(tmp_path), "applications", load_ts=F.col("timestamp"), ledger=FileLedger(spark, f"{tmp_path}/ledger"))
    assert rows(noted, *plain.columns) == rows(plain) and set(noted.columns) == set(plain.columns)
