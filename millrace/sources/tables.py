"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_hierarchy(
    spark: SparkSession,
    table: str,
    id_col: str = "id",
    parent: str = "parentid",
    group: str = "CfgGroup",
) -> DataFrame:
    """``(id, parentid, cfg_group)`` of a catalog table."""
    return spark.table(table).select(
        F.col(id_col).cast("string").alias("id"),
        F.col(parent).cast("string").alias("parentid"),
        F.col(group).alias("cfg_group"),
    )


def read_facts(spark: SparkSession, table: str) -> DataFrame:
    """Fact rows of a catalog table, as the daily figures read them."""
    return spark.table(table)
