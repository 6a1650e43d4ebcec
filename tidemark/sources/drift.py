"""Schema drift against a pinned contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


class SchemaDrift(ValueError):
    """Input columns that the contract does not know."""


def check_drift(df: DataFrame, contract: T.StructType, on_new: str = "add") -> DataFrame:
    """Bring ``df`` to the contract: its columns first, in its order and types.

    Columns the input lacks become NULL. Unknown columns are kept behind the contract's
    (``add``) or refused (``fail``).
    """
    if on_new not in ("add", "fail"):
        raise ValueError(f"on_new must be 'add' or 'fail', not {on_new!r}")
    new = [c for c in df.columns if c not in contract.names]
    if new and on_new == "fail":
        raise SchemaDrift(f"columns not in the contract: {', '.join(new)}")
    known = [
        (F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in contract
    ]
    return df.select(*known, *new)


def widened(contract: T.StructType, df: DataFrame) -> T.StructType:
    """The contract plus the columns of ``df`` it lacks: the schema to restart a stream with."""
    extra = [T.StructField(f.name, f.dataType) for f in df.schema if f.name not in contract.names]
    return T.StructType(contract.fields + extra)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Files of differing schemas as one table, absent columns NULL."""
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(path)
