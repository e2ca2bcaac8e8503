"""The enrichment runs once per query and shuffles the fact no more than needed."""

import pytest

from tillmart.operators import enrich as E
from tillmart.plans.catalog import QUERIES
from tillmart.sources.tables import RetailInputs

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["sales_rank", "incentive", "sales_incentive_mart", "top_sellers"])
def test_totals_are_computed_once(spark, name):
    """Ranks and best sellers read the totals twice: from a stored table, not from the sales."""
    assert not [f for f in QUERIES[name](spark, SF_SMALL).inputFiles() if "lineitem" in f]


def test_sales_team_is_broadcast_while_it_is_small(spark, monkeypatch):
    r = RetailInputs(spark, SF_SMALL)
    hinted = lambda: "strategy=broadcast" in E.enrich(r.sales(), r.customer(), r.store(), r.sales_team())._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(E, "BROADCAST_ROWS", r.sales_team().count())
    assert hinted()
    monkeypatch.setattr(E, "BROADCAST_ROWS", r.sales_team().count() - 1)
    assert not hinted()


def test_landing_zone_does_not_shuffle_the_sales_by_month(spark, tmp_uri):
    """The months' numbers of parts are a stored table, broadcast to the sales."""
    from tillmart.sources import landing_fixture as LF
    from tillmart.sources.tables import Tables, sales_keyed

    sales_keyed(Tables(spark, SF_SMALL)).write.parquet(f"{tmp_uri}/fact")
    plan = LF.with_file(spark.read.parquet(f"{tmp_uri}/fact"), 25, f"{tmp_uri}/parts")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan, plan


def test_run_does_not_shuffle_the_detail_by_file(spark, tmp_uri, monkeypatch):
    """What counts of each file is a stored table, broadcast to the detail of every mart."""
    from tillmart.plans import job

    r = RetailInputs(spark, SF_SMALL)
    head = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"
    spark.createDataFrame([(head,), ("1,1,pen,2024-01-05,1,1.00,2,2.00",)], "value string").coalesce(1).write.text(f"{tmp_uri}/in")
    (part,) = [p for p in spark.read.text(f"{tmp_uri}/in").inputFiles()]
    job.fs.mkdirs(spark, f"{tmp_uri}/landing")
    job.fs.rename(spark, part, f"{tmp_uri}/landing/a.csv")
    plans, write = {}, job._dynamic

    def kept(df, path, keys):
        plans[path.rsplit("/", 1)[-1]] = df._jdf.queryExecution().executedPlan().toString()
        write(df, path, keys)

    monkeypatch.setattr(job, "_dynamic", kept)
    job.run(spark, f"{tmp_uri}/landing", job.Dimensions(r.customer(), r.store(), r.sales_team()), f"{tmp_uri}/out")
    assert len(plans) == 6  # five marts and the lost sales
    assert not [name for name, plan in plans.items() if "hashpartitioning(path" in plan]


def test_enrichment_shuffles_the_sales_before_their_dimensions_join(spark):
    """With few salespersons and stores, the shuffle by customer and the rebalance of a
    write carry the sales' own columns: the broadcast joins stand above them."""
    r = RetailInputs(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        rows = E.enrich(r.sales(), r.customer(), r.store(), r.sales_team(), rebalance=("sales_date",))
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    at = [next(i for i, x in enumerate(lines) if w in x) for w in ("BroadcastHashJoin [store_id", "BroadcastHashJoin [sales_person_id", "REBALANCE_PARTITIONS_BY_COL", "SortMergeJoin [customer_id")]
    assert at == sorted(at), plan
    assert rows.count() == r.sales().count()


def test_sales_are_never_broadcast(spark, tmp_uri, monkeypatch):
    """Spark takes the few columns read of stored sales for small: the customers, not the
    sales, are broadcast while they are few, and a sort-merge join follows beyond that."""
    r = RetailInputs(spark, SF_SMALL)
    r.sales().write.parquet(f"{tmp_uri}/sales")
    sales = spark.read.parquet(f"{tmp_uri}/sales")
    rows = lambda: E.enrich(sales, r.customer(), r.store(), r.sales_team())
    plan = lambda: rows()._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan() and "SortMergeJoin" not in plan(), plan()
    n = rows().count()
    monkeypatch.setattr(E, "few_customers", lambda customer: False)
    assert "BuildLeft" not in plan() and "SortMergeJoin [customer_id" in plan(), plan()
    monkeypatch.setattr(E, "few", lambda dimension: False)
    assert "BuildLeft" not in plan(), plan()
    assert rows().count() == n == sales.count()
