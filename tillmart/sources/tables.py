"""The provided Parquet tables, and the retail inputs derived from them.

The provided tables are a TPC-H-like star schema.  They stand in for the
landed sales files and the three dimension tables as follows:

* sales       = lineitem ⋈ orders ⋈ part ⋈ supplier
* customer    = customer ⋈ nation
* store       = nation: the chain has a store in every nation
* sales_team  = supplier ⋈ nation

Every query reads the whole tables.  ``unmatched_sales`` alone, whose feature
is to account for sales without a dimension row, uses the reduced dimensions of
``reduced()``: members in good standing (account not in debit, region with
stores), chosen by business attributes, not by key ranges.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions.scalars import money, split_name
from tillmart.schemas import ADDITIONAL_COLUMN

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# --- fixed values of the fixture mapping ----------------------------------------
# Joining date of every dimension row.
DIMENSION_DATE = dt.date(2020, 1, 1)
# Region without stores of the chain.
NO_STORE_REGION = "MIDDLE EAST"
# -----------------------------------------------------------------------------


class Tables:
    """Lazy access to ``<sf_dir>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def _pad(c: str, width: int) -> F.Column:
    """Zero-padded to ``width``; longer numbers stay whole."""
    text = F.col(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def sales(t: Tables) -> DataFrame:
    """The sales facts that the marts read: customer, store, date, salesperson,
    total.  Product and price are read by none of them, so ``part`` is not joined.

    Two large inputs (lineitem, orders) meet in a shuffle join on the order
    key; supplier is joined by key and broadcast only when Spark's size
    estimate (or AQE's runtime size) is under the broadcast threshold.
    """
    joined = _priced(t, "l_orderkey", "l_suppkey", "l_extendedprice")
    return joined.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("s_nationkey").alias("store_id"),
        F.col("o_orderdate").cast("date").alias("sales_date"),
        F.col("l_suppkey").alias("sales_person_id"),
        money("l_extendedprice").alias("total_cost"),
    )


def _priced(t: Tables, *columns: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ supplier with the named lineitem columns.  Supplier
    last: the fact leaves this join hash-partitioned by l_suppkey (=
    sales_person_id), which the sales-team join of the enrichment reuses when
    it is a sort-merge join."""
    li = t("lineitem").select(*columns)
    od = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    sp = t("supplier").select("s_suppkey", "s_nationkey")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner").join(sp, li.l_suppkey == sp.s_suppkey, "inner")


def sales_keyed(t: Tables) -> DataFrame:
    """The landed sales columns plus ``_spread = l_orderkey + l_linenumber``, a
    row-level key that spreads one month over several landing files
    (``landing_fixture``)."""
    pt = t("part").select("p_partkey", "p_name", "p_retailprice")
    joined = _priced(t, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    joined = joined.join(pt, F.col("l_partkey") == pt.p_partkey, "inner")
    return joined.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("s_nationkey").alias("store_id"),
        F.col("p_name").alias("product_name"),
        F.col("o_orderdate").cast("date").alias("sales_date"),
        F.col("l_suppkey").alias("sales_person_id"),
        money("p_retailprice").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("total_cost"),
        F.lit(None).cast("string").alias(ADDITIONAL_COLUMN),
        (F.col("l_orderkey") + F.col("l_linenumber")).alias("_spread"),
    )


def customer_dim(t: Tables, reduced: bool = False) -> DataFrame:
    c = t("customer")
    c = c.where(F.col("c_acctbal") >= 0) if reduced else c
    n = t("nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
        F.col("c_custkey").alias("customer_id"),
        split_name("c_name", 1).alias("first_name"),
        split_name("c_name", 2).alias("last_name"),
        F.col("n_name").alias("address"),
        _pad("c_nationkey", 6).alias("pincode"),
        F.concat(F.lit("91"), _pad("c_custkey", 8)).alias("phone_number"),
        F.lit(DIMENSION_DATE).alias("customer_joining_date"),
    )


def store_dim(t: Tables, reduced: bool = False) -> DataFrame:
    n = t("nation")
    if reduced:
        r = t("region").where(F.col("r_name") != NO_STORE_REGION)
        n = n.join(r, n.n_regionkey == r.r_regionkey, "left_semi")
    return n.select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("address"),
        _pad("n_regionkey", 6).alias("store_pincode"),
        F.concat(F.lit("Manager "), F.col("n_name")).alias("store_manager_name"),
        F.lit(DIMENSION_DATE).alias("store_opening_date"),
        F.lit(None).cast("string").alias("reviews"),
    )


def sales_team_dim(t: Tables, reduced: bool = False) -> DataFrame:
    """Sales team with each store's manager = its lowest key.

    The manager is found with a grouped ``min`` (partial aggregation, one row
    per store) joined back, not a window: a store holding most of the staff
    would otherwise put all of them into one task.
    """
    s = t("supplier")
    s = (s.where(F.col("s_acctbal") >= 0) if reduced else s).select("s_suppkey", "s_name", "s_nationkey")
    n = t("nation").select("n_nationkey", "n_name")
    managers = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("manager_id"))
    return (
        s.join(n, s.s_nationkey == n.n_nationkey, "inner")
        .join(managers, "s_nationkey", "inner")
        .select(
            F.col("s_suppkey").alias("id"),
            split_name("s_name", 1).alias("first_name"),
            split_name("s_name", 2).alias("last_name"),
            F.col("manager_id"),
            F.when(F.col("s_suppkey") == F.col("manager_id"), F.lit("Y")).otherwise(F.lit("N")).alias("is_manager"),
            F.col("n_name").alias("address"),
            _pad("s_nationkey", 6).alias("pincode"),
            F.lit(DIMENSION_DATE).alias("joining_date"),
        )
    )


class RetailInputs:
    """Sales fact and dimensions derived from one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.tables = Tables(spark, sf_dir)

    def sales(self) -> DataFrame:
        return sales(self.tables)

    def customer(self) -> DataFrame:
        return customer_dim(self.tables)

    def store(self) -> DataFrame:
        return store_dim(self.tables)

    def sales_team(self) -> DataFrame:
        return sales_team_dim(self.tables)

    def reduced(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Customer, store and sales team in good standing (``unmatched_sales``)."""
        return tuple(dim(self.tables, reduced=True) for dim in (customer_dim, store_dim, sales_team_dim))
