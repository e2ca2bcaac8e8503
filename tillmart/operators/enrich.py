"""Enrichment of the sales fact with the customer, store and sales-team
dimensions, and accounting for the sales those inner joins drop.

Join strategy: all three are N:1 equi-joins on the dimension key.  The sales
team and the stores are counted and marked for broadcast up to ``BROADCAST_ROWS``
rows each: Spark has no size for a joined dimension and would shuffle the whole
fact before AQE measures it.  The customers are marked for broadcast while their
counted rows fit ``spark.sql.autoBroadcastJoinThreshold``.  A dimension beyond its
limit is marked for a sort-merge join (with AQE skew splitting for hot keys): without
a mark Spark may broadcast the *fact*, since it takes the few columns read of
compressed files for small, and millions of rows pass through the driver.

With both marked, the customer join runs first: at scale it shuffles the whole
fact, which has only its own columns then, and so does a rebalance for a write,
before the broadcast joins add theirs.  Otherwise the sales-team join runs first:
the fact usually arrives hash-partitioned by the salesperson key (see
``tables.sales``), so as a sort-merge join it shuffles only the dimension; it and
the store join remove rows before the customer join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.schemas import ENRICHED_COLUMNS

# Rows of a sales team (some 200 bytes each) that is broadcast.
BROADCAST_ROWS = 500_000
ROW_BYTES = 200
FACT_COLUMNS = ["customer_id", "store_id", "sales_date", "sales_person_id", "total_cost"]


def customer_side(customer: DataFrame) -> DataFrame:
    return customer.select("customer_id", "first_name", "last_name", "address", "pincode", "phone_number")


def store_side(store: DataFrame) -> DataFrame:
    return store.select(
        F.col("id").alias("store_id"),
        F.col("address").alias("store_address"),
        "store_manager_name",
    )


def sales_team_side(sales_team: DataFrame) -> DataFrame:
    return sales_team.select(
        F.col("id").alias("sales_person_id"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
        F.col("joining_date").alias("sales_person_joining_date"),
        "manager_id",
        "is_manager",
    )


def few(dimension: DataFrame) -> bool:
    """Whether ``dimension`` has few enough rows to be marked for broadcast, and the
    session broadcasts at all."""
    limit = dimension.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")
    return not limit.startswith("-") and dimension.count() <= BROADCAST_ROWS


def few_customers(customer: DataFrame) -> bool:
    """Whether the counted customers fit the session's broadcast threshold."""
    limit = customer.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")
    if limit.startswith("-"):
        return False
    fits = customer.sparkSession.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit) // ROW_BYTES
    return customer.count() <= min(fits, BROADCAST_ROWS // 10)


def _marked(dimension: DataFrame, broadcast: bool) -> DataFrame:
    """``dimension`` with its join strategy; the fact is never the side that is broadcast."""
    return F.broadcast(dimension) if broadcast else dimension.hint("merge")


def enrich(
    sales: DataFrame,
    customer: DataFrame,
    store: DataFrame,
    sales_team: DataFrame,
    carry: tuple[str, ...] = (),
    rebalance: tuple[str, ...] = (),
) -> DataFrame:
    """Sales ⋈ sales_team ⋈ store ⋈ customer (inner), 19 uniquely named
    columns, plus the fact columns named in ``carry`` (e.g. the source file).
    ``rebalance``: fact columns on which the rows are rebalanced for a write."""
    joined = sales.select(*FACT_COLUMNS, *carry)
    spread = lambda df: df.hint("rebalance", *rebalance) if rebalance else df
    team, stores, customers = sales_team_side(sales_team), store_side(store), customer_side(customer)
    small = few(team), few(stores)
    team, stores = (_marked(d, few_rows) for d, few_rows in zip((team, stores), small))
    customers = _marked(customers, few_customers(customers))
    if all(small):
        joined = spread(joined.join(customers, "customer_id", "inner"))
        joined = joined.join(team, "sales_person_id", "inner").join(stores, "store_id", "inner")
    else:
        joined = joined.join(team, "sales_person_id", "inner").join(stores, "store_id", "inner")
        joined = spread(joined.join(customers, "customer_id", "inner"))
    return joined.select(*ENRICHED_COLUMNS, *carry)


def unmatched_sales(sales: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame) -> DataFrame:
    """Sales lost by the inner joins, one row per (dimension, key).

    A sale is charged to the first dimension it misses, in the reference's
    join order (customer, store, sales team), so matched rows plus lost rows
    equal the input.  One pass over the fact: left joins against the distinct
    key sets of the dimensions, then a grouped count and sum.
    """
    c_keys = customer.select("customer_id").distinct().withColumn("_has_c", F.lit(True))
    s_keys = store.select(F.col("id").alias("store_id")).distinct().withColumn("_has_s", F.lit(True))
    t_keys = sales_team.select(F.col("id").alias("sales_person_id")).distinct().withColumn("_has_t", F.lit(True))
    # Few salespersons and stores are broadcast, so only the customers' keys shuffle the
    # fact.  Flags are order-free; the sales-team keys go first, on the key the
    # fact is usually partitioned by already (see ``tables.sales``).
    t_keys, s_keys = (F.broadcast(k) if few(d) else k for k, d in ((t_keys, sales_team), (s_keys, store)))
    flagged = (
        sales.select("customer_id", "store_id", "sales_person_id", "total_cost")
        .join(t_keys, "sales_person_id", "left")
        .join(s_keys, "store_id", "left")
        .join(c_keys, "customer_id", "left")
    )
    dimension = (
        F.when(F.col("_has_c").isNull(), F.lit("customer"))
        .when(F.col("_has_s").isNull(), F.lit("store"))
        .when(F.col("_has_t").isNull(), F.lit("sales_team"))
    )
    key = (
        F.when(F.col("_has_c").isNull(), F.col("customer_id"))
        .when(F.col("_has_s").isNull(), F.col("store_id").cast("long"))
        .otherwise(F.col("sales_person_id"))
    )
    return (
        flagged.select(dimension.alias("dimension"), key.alias("dim_key"), "total_cost")
        .where(F.col("dimension").isNotNull())
        .groupBy("dimension", "dim_key")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_cost").cast("decimal(18,2)").alias("lost_total"))
    )
