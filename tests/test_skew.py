"""A key holding a third of all rows is split over several tasks at run time.

The join-back designs (``marts.group_total``, ``ranking.rank_desc``) rely on
AQE's skew-join handling: the hot key's rows are cut into several tasks, and
the other side (one total per key) is replicated to them.
"""

import contextlib

from pyspark.sql import functions as F

from tillmart.operators import marts as M
from tillmart.operators.ranking import rank_desc

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
}


@contextlib.contextmanager
def conf(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot_rows(spark, n=30_000):
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.lit("2024-01").alias("m"),
        (F.col("id") % 100).cast("decimal(18,2)").alias("v"),
    )


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_group_total_splits_the_hot_key(spark):
    with conf(spark, SKEW_CONF):
        rows = _hot_rows(spark)
        out = M.group_total(rows, ["k", "m"], "v", "t")
        assert "skew=true" in _final_plan(out)
        hot = out.where("k = 0").select("t").distinct().collect()
        expected = rows.where("k = 0").agg(F.sum("v")).first()[0]
        assert [r.t for r in hot] == [expected]


def test_rank_join_back_splits_a_hot_tie(spark):
    with conf(spark, SKEW_CONF):
        # a third of the rows tie on one (group, value): a hot join key.  The
        # rows carry their id, so the hot partition is large in shuffle bytes
        # too (identical rows would compress to almost nothing).
        hot = F.col("id") % 3 == 0
        rows = spark.range(0, 30_000).select(
            "id",
            F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
            F.when(hot, F.lit(1000)).otherwise(F.col("id")).alias("v"),
        )
        out = rank_desc(rows, ["g"], "v")
        assert "skew=true" in _final_plan(out)
        got = out.where("g = 'hot'").select("rnk").distinct().collect()
        assert [r.rnk for r in got] == [rows.where("g = 'hot' AND v > 1000").count() + 1]


def test_hot_salesperson_is_split_in_the_enrichment(spark):
    """60 % of the sales on one salesperson: the fact comes out of a join on the
    salesperson, so both that join and the sales-team join must be split."""
    from conftest import SF_SMALL
    from tillmart.operators import enrich as E
    from tillmart.sources.tables import RetailInputs

    r = RetailInputs(spark, SF_SMALL)
    team = r.sales_team()
    person = F.when(F.col("id") % 5 < 3, F.lit(1)).otherwise(F.col("id") % 10 + 1).cast("long")
    facts = spark.range(60_000).select(
        (F.col("id") % 100 + 1).alias("customer_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int")).alias("sales_date"),
        person.alias("sales_person_id"), (F.col("id") % 90).cast("decimal(18,2)").alias("total_cost"),
    )
    with conf(spark, {**SKEW_CONF, "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}):
        where = spark.read.parquet(f"{SF_SMALL}/supplier.parquet").select(
            F.col("s_suppkey").alias("sales_person_id"), F.col("s_nationkey").alias("store_id")
        )
        sales = facts.join(where, "sales_person_id")
        out = E.enrich(sales, r.customer(), r.store(), team)
        plan = _final_plan(out)
        assert plan.count("skew=true") >= 2, plan
        assert out.count() == sales.join(r.customer().select("customer_id"), "customer_id", "left_semi").count()
