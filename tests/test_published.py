"""All marts of a publication appear together or not at all."""

import pytest
from pyspark.sql import functions as F
from test_invariants import HEADER, _dims, _zone, put

from tillmart.plans import job
from tillmart.session import scratch_path
from tillmart.sinks import parquet as P
from tillmart.sinks import published as PB

ROW = "1,1,oats,{},1,2.00,4,{}\n"


def _totals(spark, base):
    names = list(PB.manifest(spark, base)["marts"])
    money = {"customer_detail": "total_cost", "sales_team_detail": "total_cost", "sales_partitioned": "total_cost"}
    return {n: PB.read(spark, base, n).agg(F.sum(money.get(n, "total_sales"))).first()[0] for n in names}


def test_a_publication_that_stops_leaves_the_old_set_whole(spark, monkeypatch):
    zone, out = _zone(spark, {"a.csv": HEADER + ROW.format("2023-05-01", "8.00")}), scratch_path(spark, "published")
    base = f"{out}/published"
    with pytest.raises(LookupError):
        PB.read(spark, base, "sales_mart")
    job.run(spark, zone, _dims(spark), out, publish=True)
    assert {str(v) for v in _totals(spark, base).values()} == {"8.00"} and len(_totals(spark, base)) == 5

    put(spark, zone, {"b.csv": HEADER + ROW.format("2023-05-02", "1.50")})

    def stops(df, base, *args, write=P.write_snapshot, **kw):
        if base.endswith("sales_mart"):
            raise OSError("stopped")
        return write(df, base, *args, **kw)

    with monkeypatch.context() as m:
        m.setattr(P, "write_snapshot", stops)
        with pytest.raises(OSError):
            job.run(spark, zone, _dims(spark), out, publish=True)
    assert PB.versions(spark, base) == [1]
    assert {str(v) for v in _totals(spark, base).values()} == {"8.00"}

    # The files were not closed: the next run takes and publishes them.
    job.run(spark, zone, _dims(spark), out, publish=True)
    assert PB.versions(spark, base) == [1, 2]
    assert {str(v) for v in _totals(spark, base).values()} == {"9.50"}
    assert PB.read(spark, base, "sales_mart", 1).first().total_sales != PB.read(spark, base, "sales_mart", 2).first().total_sales


def test_a_taken_version_is_not_overwritten(spark, monkeypatch):
    base = scratch_path(spark, "published-twice")
    df = spark.range(3)
    PB.publish(spark, base, {"m": (df, ())})
    monkeypatch.setattr(PB, "versions", lambda *a: [])
    with pytest.raises(RuntimeError):
        PB.publish(spark, base, {"m": (spark.range(5), ())})
    monkeypatch.undo()
    assert PB.versions(spark, base) == [1]
