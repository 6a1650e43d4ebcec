"""A ledger of landed files: what each holds, noted once when it is first seen.

Landing folders only grow, so the schema and the row count of a file need to be read from its
footer once. The ledger is a parquet table with a row per file: entity, path, time and size of
the file, its row count and the columns of the files it was noted with. An update lists the
folder, which opens no file, and opens the footers of those it does not know; everything else
(schema of an entity, rows landed) is read from the ledger, however much has landed.

An update is appended in one job. If it fails, its files are noted by the next one.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.sources.drift import SchemaDrift

# Files whose footers one job reads: their paths are all the driver holds.
FILES_AT_ONCE = 10_000
_ENTRY = "entity string, path string, modified timestamp, bytes long, rows long, columns string"
_FILE = "_metadata.file_path AS path", "_metadata.file_modification_time AS modified", "_metadata.file_size AS bytes"


class FileLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self, entity: str | None = None) -> DataFrame:
        try:
            found = self.spark.read.schema(_ENTRY).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = self.spark.createDataFrame([], _ENTRY)
        return found if entity is None else found.filter(F.col("entity") == entity)

    def update(self, entity: str, folder: str) -> int:
        """Note the files of ``folder`` the ledger does not know; how many those were.

        A file written anew, with another time or size, is noted again and its new row counts.
        """
        listed = self.spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet").load(folder)
        # `path` names the file for the reader, the metadata's path is how rows name it
        listed = listed.selectExpr("path AS location", *_FILE)
        new = listed.join(self.entries(entity), ["path", "modified", "bytes"], "left_anti")
        locations = sorted(r["location"] for r in new.select("location").collect())
        for start in range(0, len(locations), FILES_AT_ONCE):
            self._note(entity, locations[start:start + FILES_AT_ONCE])
        return len(locations)

    def _note(self, entity: str, locations: list[str]) -> None:
        schema = self.spark.read.option("mergeSchema", "true").parquet(*locations).schema  # tasks read the footers
        files = self.spark.read.format("binaryFile").load(locations).selectExpr(*_FILE)
        counts = self.spark.read.schema(schema).parquet(*locations).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
        noted = files.join(counts, "path", "left").select(
            F.lit(entity).alias("entity"), "path", "modified", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"),
            F.lit(json.dumps(schema.jsonValue(), sort_keys=True)).alias("columns"),
        )
        noted.write.mode("append").parquet(self.path)

    def schema(self, entity: str, contract: T.StructType) -> T.StructType:
        """The contract, then all other columns that have landed, in the order of their names.

        Few distinct texts come back: one for each change of the feed's schema.
        """
        found: dict[str, T.DataType] = {}
        for row in self.entries(entity).select("columns").distinct().collect():
            for field in T.StructType.fromJson(json.loads(row["columns"])):
                if found.setdefault(field.name, field.dataType) != field.dataType:
                    raise SchemaDrift(f"{entity}.{field.name} landed as {found[field.name].simpleString()} and as {field.dataType.simpleString()}")
        return T.StructType(contract.fields + [T.StructField(n, found[n]) for n in sorted(found) if n not in contract.names])

    def counts(self) -> DataFrame:
        """Files and rows landed per entity, from the newest note of each file."""
        newest = self.entries().groupBy("entity", "path").agg(F.max_by("rows", "modified").alias("rows"))
        return newest.groupBy(F.col("entity").alias("table")).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
