"""The two source tables, derived from the star-schema test data (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# The columns used, so that no file is opened to look for a schema.
COLUMNS = {
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def therapists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _therapists(_table(spark, sf_dir, "customer"))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interactions(_table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer"))


def both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Interactions and therapists, resolving each underlying table once."""
    customers = _table(spark, sf_dir, "customer")
    return _interactions(_table(spark, sf_dir, "orders"), customers), _therapists(customers)


def _therapists(customers: DataFrame) -> DataFrame:
    return customers.selectExpr(
        "CAST(c_custkey AS STRING) AS id",
        "CASE WHEN c_custkey % 17 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS organization_id",
        f"{_joined('c_custkey')} AS date_joined",
    )


def _interactions(orders: DataFrame, customers: DataFrame) -> DataFrame:
    owners = customers.selectExpr("c_custkey AS o_custkey", "CAST(c_nationkey AS BIGINT) AS nation")
    return orders.join(owners, "o_custkey").selectExpr(
        "o_orderkey AS seq",
        "CAST(o_custkey AS STRING) AS therapist_id",
        "CAST(o_orderdate AS DATE) AS interaction_date",
        "1L AS counter",
        "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 4 END AS chat_count",
        "CASE WHEN o_orderkey % 3 = 0 THEN 1L ELSE 0L END AS call_count",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN (nation + 1) % 25 "
        "ELSE nation END AS organization_id",
        f"{_joined('o_custkey')} AS organization_date_joined",
    )


def _joined(key: str) -> str:
    return f"date_add(DATE'1994-01-01', CAST({key} % 365 AS INT))"
