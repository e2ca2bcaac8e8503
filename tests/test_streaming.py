"""The streaming ingest takes each landed file exactly once across restarts."""

import os

from pyspark.sql import functions as F

from tillmart.streaming import ingest as S

HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def _write(d, name, n):
    with open(os.path.join(d, name), "w") as f:
        f.write(HEADER + "\n")
        for i in range(n):
            f.write(f"{i},121,oats,2023-05-01,1,2.00,1,2.00\n")


def _run(spark, landing, out):
    q = S.start(spark, "file://" + landing, "file://" + out, "file://" + out + "/_checkpoint",
                max_files_per_trigger=2)
    q.awaitTermination()
    assert q.exception() is None


def test_restart_takes_only_new_files(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    os.makedirs(landing)
    for i in range(3):
        _write(landing, f"day{i}.csv", 5)
    _run(spark, landing, out)
    rows = S.read_rows(spark, "file://" + out)
    assert rows.count() == 15
    _run(spark, landing, out)  # restart, nothing new
    assert S.read_rows(spark, "file://" + out).count() == 15
    _write(landing, "day3.csv", 4)
    _run(spark, landing, out)
    rows = S.read_rows(spark, "file://" + out)
    assert rows.count() == 19
    assert rows.groupBy("file_name").count().where(F.col("count") > 5).count() == 0


def test_unparsable_rows_are_kept_apart(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    os.makedirs(landing)
    _write(landing, "day0.csv", 3)
    with open(os.path.join(landing, "bad.csv"), "w") as f:
        f.write(HEADER + "\n1,121,oats,2023-05-01,1,2.00,one,2.00\n2,121,oats,2023-05-01,1,2.00,1,2.00\n")
    _run(spark, landing, out)
    assert S.read_rows(spark, "file://" + out).count() == 4
    bad = S.read_corrupt(spark, "file://" + out).collect()
    assert [(r.file_name, r.record) for r in bad] == [("bad.csv", "1,121,oats,2023-05-01,1,2.00,one,2.00")]
    assert "batch_id" not in S.read_rows(spark, "file://" + out).columns


def test_finished_files_are_archived(spark, tmp_path):
    """cleanSource=archive moves a file away once a later batch has started,
    so files of all but the last batch leave the landing folder, and a
    restart still counts every row once."""
    landing, out, archive = str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "archive")
    os.makedirs(landing)
    for i in range(4):
        _write(landing, f"day{i}.csv", 2)
    for _ in range(2):
        q = S.start(spark, "file://" + landing, "file://" + out, "file://" + out + "/_checkpoint",
                    max_files_per_trigger=1, archive_dir="file://" + archive)
        q.awaitTermination()
        assert q.exception() is None
    left = sorted(os.listdir(landing))
    archived = sorted(f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv"))
    assert len(left) <= 1 and sorted(left + archived) == [f"day{i}.csv" for i in range(4)]
    assert S.read_rows(spark, "file://" + out).count() == 8


def test_special_file_names(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    os.makedirs(landing)
    for name in ("a b+c.csv", "s[1].csv", "p%41.csv"):
        _write(landing, name, 2)
    _run(spark, landing, out)
    rows = S.read_rows(spark, "file://" + out)
    assert sorted(r.file_name for r in rows.select("file_name").distinct().collect()) == [
        "a b+c.csv", "p%41.csv", "s[1].csv"]
    assert rows.count() == 6


def test_monthly_totals_follow_restarts_late_files_and_replays(spark, tmp_path):
    """Totals equal the batch mart of all rows after a restart, with a late file
    for a month already counted, and after a batch whose commit was lost."""
    from conftest import SF_SMALL
    from tillmart.operators import enrich as E
    from tillmart.operators import marts as M
    from tillmart.sources.tables import RetailInputs
    from tillmart.streaming import totals as ST

    r = RetailInputs(spark, SF_SMALL)
    dims = r.customer(), r.store(), r.sales_team()
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    os.makedirs(landing)

    def land(name, month, n, cost):
        with open(os.path.join(landing, name), "w") as f:
            f.write(HEADER + "\n")
            for i in range(n):
                f.write(f"{1 + i % 4},{1 + i % 3},oats,2023-{month:02d}-01,{1 + i % 2},1.00,1,{cost + i}.25\n")

    def totals():
        q = ST.start(spark, "file://" + out, *dims, "file://" + out, "file://" + out + "/_totals", max_files_per_trigger=1)
        q.awaitTermination()
        assert q.exception() is None
        got = sorted(map(tuple, ST.read(spark, "file://" + out).collect()))
        rows = E.enrich(S.read_rows(spark, "file://" + out), *dims)
        want = M.sales_monthly_totals(M.sales_team_detail(rows))
        assert got == sorted(map(tuple, want.select(*ST.read(spark, "file://" + out).columns).collect()))
        return got

    land("a.csv", 5, 12, 1)
    land("b.csv", 6, 6, 2)
    _run(spark, landing, out)
    first = totals()
    assert first and totals() == first  # nothing new
    land("late.csv", 5, 7, 3)
    land("new.csv", 7, 5, 4)
    _run(spark, landing, out)
    second = totals()
    assert len(second) > len(first) and second != first

    # The commit of the last batch of each stream is lost: both are replayed.
    for log in (os.path.join(out, "_checkpoint", "commits"), os.path.join(out, "_totals", "commits")):
        last = max((n for n in os.listdir(log) if n.isdigit()), key=int)
        for n in (last, f".{last}.crc"):
            if os.path.exists(os.path.join(log, n)):
                os.unlink(os.path.join(log, n))
    _run(spark, landing, out)
    assert S.read_rows(spark, "file://" + out).count() == 30
    assert totals() == second
