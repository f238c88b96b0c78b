"""Denormalised order mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.sources.files import write_parquet


def orders_with_places(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Order facts with customer, nation and region. The dimensions are joined to each other first, so the
    fact table takes part in one join only."""
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    customers = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "c_mktsegment", "n_name", "r_name"
    )
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def build_order_mart(
    orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame, out: str
) -> DataFrame:
    """Writes the mart as Parquet by region and returns it."""
    wide = orders_with_places(orders, customer, nation, region).select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        F.year("o_orderdate").alias("order_year"),
        "c_custkey",
        "c_mktsegment",
        "n_name",
        "r_name",
    )
    write_parquet(wide, out, ("r_name",))
    return orders.sparkSession.read.parquet(out)
