"""Detail marts and the two monthly marts.

The reference computes monthly totals as an unordered window ``sum`` followed
by ``distinct()``.  Here the same result comes from ``groupBy().agg(sum)``:
one exchange, with a map-side partial sum, so a hot customer or salesperson
never lands whole in one task.  Where a per-row group total is wanted (the
window's own output), it is the grouped total joined back on the group key,
again without gathering any group in one task.

The best seller of a store and month is found by comparing each total with the
group's maximum (a grouped ``max`` joined back): identical to ``rank() == 1``
with ties, without a sorted window.  The full rank (``sales_rank``) comes from
``ranking.rank_desc``: range-partitioned running counts, so no (store, month)
group is ranked by a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.functions.scalars import full_name, incentive, mart_money, money, sales_month
from tillmart.operators.ranking import rank_desc
from tillmart.schemas import CUSTOMER_DETAIL_COLUMNS, SALES_TEAM_DETAIL_COLUMNS

SALES_GROUP = ["store_id", "sales_person_id", "sales_month"]
CUSTOMER_GROUP = ["customer_id", "sales_date_month"]


def customer_detail(enriched: DataFrame) -> DataFrame:
    return enriched.select(*CUSTOMER_DETAIL_COLUMNS)


def sales_team_detail(enriched: DataFrame) -> DataFrame:
    return enriched.select(*SALES_TEAM_DETAIL_COLUMNS, sales_month("sales_date").alias("sales_month"))


def group_total(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Every row with the sum of ``value`` over its group (an unordered window
    sum), computed as a grouped sum joined back on the keys.

    A window would gather each group in one task; here only partial sums
    cross the aggregation shuffle, and AQE splits a hot group on the row side
    of the join.  ``df`` is read twice, so it should be stored (or cheap).
    NULL keys form their own group, as in a window partition.
    """
    totals = df.groupBy(*keys).agg(money(F.sum(value)).alias(name))
    cond = [df[k].eqNullSafe(totals[k]) for k in keys]
    return df.join(totals, cond, "inner").select(df["*"], totals[name])


def customer_monthly(customer_detail_df: DataFrame) -> DataFrame:
    """Customer spend per month: customer_id, full_name, address,
    phone_number, sales_date_month (``yyyy-MM``), total_sales.

    Name, address and phone are carried as grouping keys; they are functions
    of ``customer_id``, the customer dimension's primary key.
    """
    return (
        customer_detail_df.select(
            "customer_id",
            full_name("first_name", "last_name").alias("full_name"),
            "address",
            "phone_number",
            sales_month("sales_date").alias("sales_date_month"),
            "total_cost",
        )
        .groupBy("customer_id", "full_name", "address", "phone_number", "sales_date_month")
        .agg(money(F.sum("total_cost")).alias("total_sales"))
    )


def customer_monthly_of_sales(sales: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame) -> DataFrame:
    """``customer_monthly`` straight from the sales: rows with a store and a
    salesperson are summed per customer and month first, and the customer's
    attributes join the small result instead of riding through the fact joins
    and the grouping keys.  The dimension keys are primary keys, so this equals
    the mart of the enriched detail."""
    team = sales_team.select(F.col("id").alias("sales_person_id"))
    stores = store.select(F.col("id").alias("store_id"))
    totals = (
        sales.join(team, "sales_person_id", "left_semi")
        .join(stores, "store_id", "left_semi")
        .groupBy("customer_id", sales_month("sales_date").alias("sales_date_month"))
        .agg(money(F.sum("total_cost")).alias("total_sales"))
    )
    return totals.join(customer, "customer_id", "inner").select(
        "customer_id",
        full_name("first_name", "last_name").alias("full_name"),
        "address",
        "phone_number",
        "sales_date_month",
        "total_sales",
    )


def customer_window_rows(customer_detail_df: DataFrame) -> DataFrame:
    """The columns the customer window step reads."""
    return customer_detail_df.select(
        "customer_id", "sales_date", "total_cost", sales_month("sales_date").alias("sales_date_month")
    )


def customer_monthly_window(rows: DataFrame) -> DataFrame:
    """Per-row monthly total of each customer, the window step of the mart.

    ``rows`` (from ``customer_window_rows``) is read by both the grouped sum
    and the join back; callers pass stored rows so the upstream is computed
    once."""
    return group_total(rows, CUSTOMER_GROUP, "total_cost", "total_sales_every_month_by_each_customer")


def sales_monthly_totals(sales_team_detail_df: DataFrame) -> DataFrame:
    """Sales per (store, salesperson, month) with the salesperson's name."""
    return (
        sales_team_detail_df.select(
            "store_id",
            "sales_person_id",
            full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"),
            "sales_month",
            "total_cost",
        )
        .groupBy("store_id", "sales_person_id", "full_name", "sales_month")
        .agg(money(F.sum("total_cost")).alias("total_sales"))
    )


def sales_window_rows(sales_team_detail_df: DataFrame) -> DataFrame:
    """The columns the salesperson window step reads."""
    return sales_team_detail_df.select("store_id", "sales_person_id", "sales_month", "sales_date", "total_cost")


def sales_monthly_window(rows: DataFrame) -> DataFrame:
    """Per-row monthly total of each salesperson in a store (rows from
    ``sales_window_rows``, stored by the caller as above)."""
    return group_total(rows, SALES_GROUP, "total_cost", "total_sales_every_month")


def flag_top(totals: DataFrame, group: list[str], value: str, flag: str = "is_top") -> DataFrame:
    """Mark rows whose ``value`` equals the group maximum (ties all marked)."""
    best = totals.groupBy(*group).agg(F.max(value).alias("_best"))
    cond = [totals[k].eqNullSafe(best[k]) for k in group]
    return totals.join(best, cond, "inner").select(
        totals["*"], (totals[value] == best["_best"]).alias(flag)
    )


def sales_rank(totals: DataFrame) -> DataFrame:
    """``rank()`` of each salesperson's monthly total within the store, best
    first (the reference orders ascending, which would pay the worst seller).

    Computed by ``ranking.rank_desc``, not a window over (store, month): a
    store with most of the sales staff is ranked by many tasks."""
    return rank_desc(totals, ["store_id", "sales_month"], "total_sales", "rnk")


def top_sellers(totals: DataFrame) -> DataFrame:
    """Best seller(s) of every store and month; ties are all kept."""
    return flag_top(totals, ["store_id", "sales_month"], "total_sales").where("is_top").drop("is_top")


def sales_incentive(totals: DataFrame) -> DataFrame:
    """The sales-team mart: store_id, sales_person_id, full_name,
    sales_month, total_sales, incentive (1 % for the month's best seller)."""
    flagged = flag_top(totals, ["store_id", "sales_month"], "total_sales")
    return flagged.select(
        "store_id",
        "sales_person_id",
        "full_name",
        "sales_month",
        "total_sales",
        incentive("total_sales", "is_top").alias("incentive"),
    )


def conform_customer_mart(mart: DataFrame) -> DataFrame:
    """Customer mart as stored: month as DATE, money as wide as the sums.  The
    database column's DECIMAL(10,2) is applied at the JDBC edge only
    (``mart_types``), so no total can stop a run."""
    return mart.select(
        "customer_id",
        "full_name",
        "address",
        "phone_number",
        F.to_date(F.concat(F.col("sales_date_month"), F.lit("-01"))).alias("sales_date_month"),
        money("total_sales").alias("total_sales"),
    )


def mart_types(mart: DataFrame) -> DataFrame:
    """A mart with its money columns in the database table's DECIMAL(10,2), for
    a JDBC write; a total beyond it raises there (ANSI), it is never cut."""
    return mart.withColumns({c: mart_money(c) for c in ("total_sales", "incentive") if c in mart.columns})


def conform_sales_mart(mart: DataFrame) -> DataFrame:
    """Sales-team mart as stored, money as wide as the sums.

    Keys stay 64-bit: the DDL's INT would overflow on large key ranges."""
    return mart.select(
        "store_id",
        "sales_person_id",
        "full_name",
        "sales_month",
        money("total_sales").alias("total_sales"),
        money("incentive").alias("incentive"),
    )
