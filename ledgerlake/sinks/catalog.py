"""Catalog registration of lake tables for Spark SQL.

DDL is generated from the schema of the files a job actually wrote, so the
catalog can never disagree with the data (column names, types, partition
columns).  Tables are external (``LOCATION``): dropping one never deletes
data, which is what makes re-pointing a table at a new version safe.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

GOLD_TABLES = {
    # name: partition columns
    "fact_loan_performance": ("occ_classification",),
    "fact_loan_event_activity": ("event_type",),
    "fact_event_summary": ("event_type",),
    "dim_status": (),
    "dim_loan_type": (),
}


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ddl_for(
    schema: T.StructType, table: str, location: str, partition_by: tuple[str, ...] | list[str] = (), fmt: str = "parquet"
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for a Parquet table at ``location``."""
    fields = [f for f in schema.fields if f.name not in partition_by]
    fields += [schema[c] for c in partition_by]
    cols = ",\n  ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in fields)
    text = f"CREATE TABLE IF NOT EXISTS {table} (\n  {cols}\n) USING {fmt}"
    if partition_by:
        text += f"\nPARTITIONED BY ({', '.join(_q(c) for c in partition_by)})"
    location = location.replace("'", "\\'")
    return text + f"\nLOCATION '{location}'"


def register_table(
    spark: SparkSession, db: str, name: str, location: str, partition_by: tuple[str, ...] | list[str] = ()
) -> str:
    """Register (or keep) ``db.name`` over ``location`` and discover its partitions."""
    schema = spark.read.parquet(location).schema
    table = f"{_q(db)}.{_q(name)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(db)}")
    spark.sql(ddl_for(schema, table, location, partition_by))
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return table


def repoint_table(
    spark: SparkSession, db: str, name: str, location: str, partition_by: tuple[str, ...] | list[str] = ()
) -> str:
    """Point ``db.name`` at a new location (external table: the old files stay)."""
    spark.read.parquet(location)  # nothing there: the present table is left as it is
    spark.sql(f"DROP TABLE IF EXISTS {_q(db)}.{_q(name)}")
    return register_table(spark, db, name, location, partition_by)


def register_gold_tables(spark: SparkSession, db: str, root: str, tables: dict[str, tuple[str, ...]] | None = None) -> list[str]:
    """Register the gold star schema written under ``root/<table>``."""
    out = []
    for name, parts in (tables or GOLD_TABLES).items():
        out.append(repoint_table(spark, db, name, f"{root.rstrip('/')}/{name}", parts))
    return out
