"""What a run and a landing zone leave on disk, and how often a run shuffles its detail."""

import os
import time

from pyspark.sql import functions as F
from test_invariants import HEADER, _dims, _zone, put

from tillmart.plans import job
from tillmart.session import run_all, scratch_path, shared_dir, shuffles_freed
from tillmart.sinks import parquet as P
from tillmart.sources import fs

ROW = "1,1,oats,{},1,2.00,4,{}\n"


def _working(spark, kind):
    return {p for p, _, _ in fs.list_dir(spark, f"{shared_dir(spark)}/tillmart") if f"/{kind}-" in p}


def test_lines_are_deleted_once_a_run_has_stored_them(spark):
    zone = _zone(spark, {"a.csv": HEADER + ROW.format("2023-05-01", "8.00"), "bad.csv": "a,b\n1,2\n"})
    before = _working(spark, "ingest-lines")
    result = job.run(spark, zone, _dims(spark), scratch_path(spark, "run-lines"))
    assert _working(spark, "ingest-lines") == before
    assert job.Q.read(spark, result.paths["quarantine"], "lines").count() == 2


def test_a_landing_zone_leaves_no_working_tables(spark):
    from conftest import SF_SMALL
    from tillmart.sources.landing_fixture import write_landing

    before = _working(spark, "landing-staging")
    assert fs.list_dir(spark, write_landing(spark, SF_SMALL))
    assert _working(spark, "landing-staging") == before


def test_shuffle_files_are_freed_when_a_query_ends(spark, tmp_uri):
    def files():
        roots = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for root in roots for _, _, names in os.walk(root) for f in names if f.startswith("shuffle_")}

    def write(k):
        spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).count().write.parquet(f"{tmp_uri}/{k}")

    before = files()
    with shuffles_freed(spark):
        run_all(*[lambda k=k: write(k) for k in range(3)])
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert [spark.read.parquet(f"{tmp_uri}/{k}").count() for k in range(3)] == [97] * 3


def test_one_runs_detail_marts_are_written_in_place(spark, monkeypatch):
    """A single run's detail is not rebalanced again for the marts by month; with
    another run's files it is, and the marts hold the rows of both."""
    plans, write = {}, job._dynamic

    def kept(df, path, keys):
        plans[path.rsplit("/", 1)[-1]] = df._jdf.queryExecution().executedPlan().toString()
        write(df, path, keys)

    monkeypatch.setattr(job, "_dynamic", kept)
    zone, out = _zone(spark, {"a.csv": HEADER + ROW.format("2023-05-01", "8.00")}), scratch_path(spark, "run-place")
    job.run(spark, zone, _dims(spark), out)
    shuffled = lambda: {n for n, plan in plans.items() if "REBALANCE" in plan}
    assert shuffled().isdisjoint({"customer_detail_mart", "sales_team_detail_mart"}), plans
    put(spark, zone, {"b.csv": HEADER + ROW.format("2023-05-02", "1.50")})
    result = job.run(spark, zone, _dims(spark), out)
    assert {"customer_detail_mart", "sales_team_detail_mart"} <= shuffled()
    for name in ("customer_detail", "sales_team_detail", "sales_partitioned"):
        assert str(job.read_mart(spark, result.paths[name]).agg(F.sum("total_cost")).first()[0]) == "9.50"


def test_a_copied_snapshot_is_not_shuffled(spark, tmp_uri, monkeypatch):
    rows = spark.range(1000).select((F.col("id") % 5).cast("string").alias("sales_month"), (F.col("id") % 3).cast("int").alias("store_id"), "id")
    P.write_partitioned(rows, f"{tmp_uri}/mart")
    mart = P.read_partitioned(spark, f"{tmp_uri}/mart", rows.schema)
    groups = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("copy", "copy")
    path = P.write_snapshot(mart, f"{tmp_uri}/copy", partition_by=P.PARTITION_KEYS, copy=True)
    stages = {s for j in groups.getJobIdsForGroup("copy") for s in groups.getJobInfo(j).stageIds}
    assert len(stages) == len(groups.getJobIdsForGroup("copy"))  # no shuffle
    assert sorted(map(tuple, P.read_partitioned(spark, path, rows.schema).select(*rows.columns).collect())) == sorted(map(tuple, rows.collect()))


def test_lost_sales_broadcast_few_salespersons_and_stores(spark):
    from tillmart.operators import enrich as E

    dims = _dims(spark)
    sales = spark.createDataFrame([(1, 1, 1, 5), (999, 1, 1, 7), (1, 999, 1, 11), (1, 1, 999, 13), (None, 1, 1, 17)], "customer_id long, store_id int, sales_person_id long, total_cost int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        lost = E.unmatched_sales(sales, dims.customer, dims.store, dims.sales_team)
        plan = lost._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.dimension, r.dim_key or 0, str(r.lost_total)) for r in lost.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin [customer_id" in plan, plan
    assert "SortMergeJoin [sales_person_id" not in plan and "SortMergeJoin [store_id" not in plan, plan
    assert got == [("customer", 0, "17.00"), ("customer", 999, "7.00"), ("sales_team", 999, "13.00"), ("store", 999, "11.00")]
