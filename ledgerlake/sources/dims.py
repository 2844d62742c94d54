"""Constant dimension relations (status / loan type).

They are built as an inline ``VALUES`` relation with bound parameters rather
than ``createDataFrame(list)``: ``VALUES`` becomes a ``LocalRelation`` whose
exact byte size the optimizer knows, so the planner's own size check
(``spark.sql.autoBroadcastJoinThreshold``) broadcasts it.  A list-backed
DataFrame is an RDD of unknown size that the planner never broadcasts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import constants as K
from ledgerlake.functions import as_timestamp
from ledgerlake.schemas import DIM_LOAN_TYPE, DIM_STATUS


def _values_relation(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    names = [f.name for f in schema.fields]
    args: dict[str, object] = {}
    tuples = []
    for i, row in enumerate(rows):
        marks = []
        for j, value in enumerate(row):
            key = f"v{i}_{j}"
            args[key] = value
            marks.append(f":{key}")
        tuples.append("(" + ", ".join(marks) + ")")
    projections = ", ".join(f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in schema.fields)
    text = f"select {projections} from values {', '.join(tuples)} as t({', '.join(names)})"
    return spark.sql(text, args=args)


def dim_status(spark: SparkSession, run_ts: dt.datetime | str | None = None, with_lineage: bool = False) -> DataFrame:
    """Status dimension: OCC classification and loss given default per status."""
    df = _values_relation(spark, K.STATUS_ROWS, DIM_STATUS)
    if with_lineage:
        df = df.withColumn("_dim_status_ts", F.current_timestamp() if run_ts is None else as_timestamp(run_ts))
    return df


def dim_loan_type(spark: SparkSession, run_ts: dt.datetime | str | None = None, with_lineage: bool = False) -> DataFrame:
    """Loan-type dimension: category, collateral and real-estate flag."""
    df = _values_relation(spark, K.LOAN_TYPE_ROWS, DIM_LOAN_TYPE)
    if with_lineage:
        df = df.withColumn("_dim_loan_type_ts", F.current_timestamp() if run_ts is None else as_timestamp(run_ts))
    return df
