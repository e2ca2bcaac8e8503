"""Invariants of the marts and the run on the provided tables."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillmart.operators import enrich as E
from tillmart.operators import marts as M
from tillmart.operators import quarantine as Q
from tillmart.plans import job
from tillmart.session import run_all, scratch_path
from tillmart.sources.landing_fixture import landing_for
from tillmart.sources.tables import RetailInputs


def _inputs(spark):
    r = RetailInputs(spark, SF_SMALL)
    return r, E.enrich(r.sales(), r.customer(), r.store(), r.sales_team())


def test_dimension_keys_are_unique(spark):
    r, _ = _inputs(spark)
    for df, key in ((r.customer(), "customer_id"), (r.store(), "id"), (r.sales_team(), "id")):
        assert df.count() == df.select(key).distinct().count()


def test_mart_totals_equal_enriched_total(spark):
    _, enriched = _inputs(spark)
    total = enriched.agg(F.sum("total_cost")).first()[0]
    cust = M.customer_monthly(M.customer_detail(enriched)).agg(F.sum("total_sales")).first()[0]
    team = M.sales_monthly_totals(M.sales_team_detail(enriched)).agg(F.sum("total_sales")).first()[0]
    assert total == cust == team


def test_enriched_plus_unmatched_is_input(spark):
    r, enriched = _inputs(spark)
    assert E.unmatched_sales(r.sales(), r.customer(), r.store(), r.sales_team()).count() == 0
    reduced = r.reduced()
    enriched = E.enrich(r.sales(), *reduced)
    lost = E.unmatched_sales(r.sales(), *reduced)
    assert lost.count() and enriched.count() + lost.agg(F.sum("n_rows")).first()[0] == r.sales().count() == 6000


def test_incentive_only_for_best_seller(spark):
    _, enriched = _inputs(spark)
    totals = M.sales_monthly_totals(M.sales_team_detail(enriched))
    ranked = M.sales_rank(totals)
    mart = M.sales_incentive(totals)
    joined = mart.join(ranked.select("store_id", "sales_person_id", "sales_month", "rnk"),
                       ["store_id", "sales_person_id", "sales_month"])
    assert joined.where((F.col("incentive") > 0) != (F.col("rnk") == 1)).count() == 0
    assert mart.count() == totals.count()


def test_incentive_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("0.50"), True), (Decimal("150.50"), True), (Decimal("9.00"), False)],
                               "total decimal(18,2), top boolean")
    got = [r.i for r in df.select(M.incentive("total", "top").alias("i")).collect()]
    assert got == [Decimal("0.01"), Decimal("1.51"), Decimal("0.00")]


def test_full_name_is_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "f string, l string")
    assert [r.n for r in df.select(M.full_name("f", "l").alias("n")).collect()] == [None, "a b"]


def test_month_expr_equals_date_format(spark):
    _, enriched = _inputs(spark)
    diff = enriched.where(F.expr("SUBSTRING(sales_date, 1, 7)") != M.sales_month("sales_date")).count()
    assert diff == 0


def test_run_is_idempotent_and_closes_ledger(spark):
    landing = landing_for(spark, SF_SMALL)
    r = RetailInputs(spark, SF_SMALL)
    dims = job.Dimensions(r.customer(), r.store(), r.sales_team())
    out = scratch_path(spark, "test-run")
    first = job.run(spark, landing, dims, out, now=dt.datetime(2024, 3, 1))
    mart1 = sorted(map(tuple, job.read_mart(spark, first.paths["sales_mart"]).collect()))
    # Reopen every file (as if the run had died before closing) and run again.
    from tillmart.operators import ledger as LG
    LG.append(LG.events(spark, first.processed, "A", dt.datetime(2024, 3, 2)), first.paths["ledger"])
    second = job.run(spark, landing, dims, out, now=dt.datetime(2024, 3, 3))
    assert sorted(second.active_before) == sorted(p.rsplit("/", 1)[-1] for p in first.processed)
    mart2 = sorted(map(tuple, job.read_mart(spark, second.paths["sales_mart"]).collect()))
    assert mart1 == mart2
    state = LG.state(LG.read(spark, first.paths["ledger"]))
    assert {r.status for r in state.collect()} == {"I"}
    # Nothing left to do: a third run finds no valid pending file.
    try:
        job.run(spark, landing, dims, out, now=dt.datetime(2024, 3, 4))
        raise AssertionError("expected NoValidFiles")
    except job.NoValidFiles:
        pass


def test_concurrent_writes_raise_the_first_failure():
    done = []

    def fail():
        raise ValueError("write failed")

    try:
        run_all(lambda: done.append(1), fail, lambda: done.append(2))
        raise AssertionError("expected the write failure")
    except ValueError:
        pass
    assert sorted(done) == [1, 2]  # the other writes still ran to completion


def test_ledger_compaction_keeps_state(spark):
    from tillmart.operators import ledger as LG
    from tillmart.sources import fs

    path = scratch_path(spark, "ledger-compact")
    names = [f"file:///landing/sales_{i}.csv" for i in range(6)]
    t = [dt.datetime(2024, 1, d) for d in range(1, 8)]
    LG.append(LG.events(spark, names[:4], "A", t[0]), path)
    LG.append(LG.events(spark, names[:2], "I", t[1]), path)
    LG.append(LG.events(spark, names[2:6], "A", t[2]), path)   # reopened and new
    LG.append(LG.events(spark, names[3:5], "I", t[3]), path)
    LG.append(LG.events(spark, names[:1], "A", t[4]), path)    # reopened after close

    def state():
        return sorted(map(tuple, LG.state(LG.read(spark, path)).collect()))

    def parts():
        return [p for p, d, _ in fs.list_dir(spark, path) if not d and p.rsplit("/", 1)[-1].startswith("part-")]

    before, n_before = state(), len(parts())
    assert LG.compact(spark, path) == n_before
    assert state() == before
    assert len(parts()) == 1
    LG.append(LG.events(spark, names[5:], "I", t[5]), path)
    n_now = len(parts())
    assert LG.compact(spark, path) == n_now and len(parts()) == 1
    assert dict((r[0], r[2]) for r in state())["sales_5.csv"] == "I"


def test_month_files_arriving_over_two_runs(spark):
    """Parts of one month landing in different runs give the same marts as
    one run over all of them (the detail is kept per source file)."""
    from tillmart.sources import fs
    from tillmart.sources.landing_fixture import write_landing

    zone = write_landing(spark, SF_SMALL, rows_per_file=25)
    r = RetailInputs(spark, SF_SMALL)
    dims = job.Dimensions(r.customer(), r.store(), r.sales_team())
    whole = job.run(spark, zone, dims, scratch_path(spark, "run-whole"), now=dt.datetime(2024, 4, 1))

    def marts(result):
        return [sorted(map(tuple, job.read_mart(spark, result.paths[k]).collect()))
                for k in ("sales_mart", "customer_mart", "sales_partitioned")]

    files = sorted(p for p, d, _ in fs.list_dir(spark, zone) if not d)
    later = [p for p in files if p.rsplit("_p", 1)[-1].startswith(("0001", "0003"))]
    assert later, "expected months with several parts"
    landing, out = scratch_path(spark, "landing-two-runs"), scratch_path(spark, "run-two")
    for p in files:
        if p not in later:
            fs.rename(spark, p, f"{landing}/{p.rsplit('/', 1)[-1]}")
    job.run(spark, landing, dims, out, now=dt.datetime(2024, 4, 2))
    for p in later:
        fs.rename(spark, p, f"{landing}/{p.rsplit('/', 1)[-1]}")
    second = job.run(spark, landing, dims, out, now=dt.datetime(2024, 4, 3))
    done_later = {p.rsplit("/", 1)[-1] for p in second.processed}
    assert done_later and done_later <= {p.rsplit("/", 1)[-1] for p in later}
    assert marts(second) == marts(whole)


def test_rejected_files_move_to_the_error_folder(spark):
    from tillmart.sources import fs
    from tillmart.sources.landing_fixture import write_landing

    zone = write_landing(spark, SF_SMALL)
    errors = scratch_path(spark, "error-files")
    r = RetailInputs(spark, SF_SMALL)
    dims = job.Dimensions(r.customer(), r.store(), r.sales_team())
    result = job.run(spark, zone, dims, scratch_path(spark, "run-move"), now=dt.datetime(2024, 5, 1),
                     error_dir=errors)
    moved = sorted(p.rsplit("/", 1)[-1] for p, d, _ in fs.list_dir(spark, errors) if not d)
    left = {p.rsplit("/", 1)[-1] for p, d, _ in fs.list_dir(spark, zone) if not d}
    assert moved == sorted(p.rsplit("/", 1)[-1] for p in result.rejected)
    assert "notes.txt" in moved and "empty.csv" in moved and not (set(moved) & left)
    lines = Q.read(spark, result.paths["quarantine"], "lines").select("file_name").distinct().count()
    assert lines == len([m for m in moved if m != "empty.csv"])


def _zone(spark, files):
    """A landing folder with the given relative paths and contents."""
    root = scratch_path(spark, "zone")
    root = root if ":" in root else f"file://{root}"
    put(spark, root, files)
    return root


def put(spark, root, files):
    """Files with the given contents, written through the shared folder's own file system."""
    jvm = spark._jvm
    for name, text in files.items():
        at = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
        out.write(bytearray(text.encode()))
        out.close()


HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost\n"


def _dims(spark):
    r = RetailInputs(spark, SF_SMALL)
    return job.Dimensions(r.customer(), r.store(), r.sales_team())


def _total(spark, result):
    return job.read_mart(spark, result.paths["sales_mart"]).agg(F.sum("total_sales")).first()[0]


def test_files_of_one_name_in_two_folders_both_count(spark):
    row = "1,{},oats,2023-05-01,1,2.00,4,8.00\n".format(1)
    zone, out = _zone(spark, {"a/same.csv": HEADER + row}), scratch_path(spark, "run-same")
    job.run(spark, zone, _dims(spark), out, now=dt.datetime(2024, 6, 1))
    path = zone.removeprefix("file://")
    import os

    os.makedirs(f"{path}/b")
    with open(f"{path}/b/same.csv", "w") as f:
        f.write(HEADER + row)
    second = job.run(spark, zone, _dims(spark), out, now=dt.datetime(2024, 6, 2))
    assert _total(spark, second) == Decimal("16.00")


def test_null_dates_large_totals_and_months_per_directory(spark):
    from tillmart.sources import fs

    rows = "".join(f"1,1,oats,{1995 + i // 12}-{i % 12 + 1:02d}-01,1,2.00,4,8.00\n" for i in range(55))
    rows += "1,1,oats,,1,2.00,4,8.00\n" + "1,1,oats,2030-01-01,1,2.00,4,120000000.00\n"
    zone = _zone(spark, {"wide.csv": HEADER + rows, "wide2.csv": HEADER + rows})
    result = job.run(spark, zone, _dims(spark), scratch_path(spark, "run-null"), now=dt.datetime(2024, 6, 1))
    mart = job.read_mart(spark, result.paths["sales_mart"])
    assert [r.total_sales for r in mart.where("sales_month is null").collect()] == [Decimal("16.00")]
    assert mart.where("total_sales = 240000000.00").count() == 1
    dirs = [p for p, d, _ in fs.list_dir(spark, result.paths["detail"]) if d]
    assert len(dirs) == 57 and all(len([1 for _, d, _ in fs.list_dir(spark, p) if d]) == 1 for p in dirs)
    try:
        M.mart_types(mart).collect()
        raise AssertionError("the database type cannot hold the total")
    except Exception as e:  # noqa: BLE001
        assert "120000000" in str(e) or "240000000" in str(e) or "OUT_OF_RANGE" in str(e).upper()


def test_quarantine_is_written_once_and_without_valid_files(spark):
    zone, out = _zone(spark, {"bad.csv": "a,b\n1,2\n", "x/bad.csv": "a\n3\n"}), scratch_path(spark, "run-bad")
    for day in (1, 2):
        try:
            job.run(spark, zone, _dims(spark), out, now=dt.datetime(2024, 6, day))
            raise AssertionError("expected NoValidFiles")
        except job.NoValidFiles:
            pass
        lines = Q.read(spark, f"{out}/quarantine", "lines")
        assert lines.count() == 4 and lines.select("path").distinct().count() == 2


def test_each_run_writes_its_own_quarantine_only(spark, monkeypatch):
    row = "1,1,oats,2023-05-01,1,2.00,4,8.00\n"
    lines = "".join(f"{i},x\n" for i in range(500))
    zone, out = _zone(spark, {"bad.csv": "a,b\n" + lines, "good1.csv": HEADER + row}), scratch_path(spark, "run-own")
    job.run(spark, zone, _dims(spark), out, processed_dir=f"{out}/done", error_dir=f"{out}/errors")
    base = f"{out}/quarantine"
    assert Q.read(spark, base, "lines").count() == 501

    def batches():
        return {r.batch: r.n for r in spark.read.parquet(f"{base}/lines").groupBy("batch").count().withColumnRenamed("count", "n").collect()}

    # Later runs bring other files: nothing of the first run is written again.
    before = batches()
    for k, text in ((2, "p\nq\n"), (3, "r\n")):
        put(spark, zone, {f"bad{k}.csv": text, f"good{k}.csv": HEADER + row})
        job.run(spark, zone, _dims(spark), out, processed_dir=f"{out}/done", error_dir=f"{out}/errors")
    assert sorted(batches().values()) == [1, 2, 501] and before.items() <= batches().items()
    assert Q.read(spark, base, "lines").count() == 504
    # A rejected file that comes again as a valid one leaves the quarantine.
    put(spark, zone, {"bad2.csv": HEADER + row})
    job.run(spark, zone, _dims(spark), out)
    assert Q.read(spark, base, "lines").count() == 502
    assert {r.file_name for r in Q.read(spark, base, "files").collect()} == {"bad.csv", "bad3.csv"}
    # A run that stops before its last write changes nothing that is read.
    put(spark, zone, {"bad4.csv": "s\n"})
    taken = spark.createDataFrame([], "path string")
    monkeypatch.setattr(Q, "_taken", lambda *a: 1 / 0)
    try:
        Q.append(spark, base, "stopped", {"lines": Q_lines(spark, f"{zone}/bad4.csv")}, taken)
        raise AssertionError("expected to stop")
    except ZeroDivisionError:
        monkeypatch.undo()
    assert Q.read(spark, base, "lines").count() == 502


def Q_lines(spark, path):
    return spark.read.text(path).select(F.lit(path).alias("path"), F.lit("bad4.csv").alias("file_name"), F.col("value").alias("line"))


def test_a_run_without_matched_rows_finishes(spark):
    from tillmart.operators import ledger as LG

    zone, out = _zone(spark, {"empty_body.csv": HEADER}), scratch_path(spark, "run-empty")
    first = job.run(spark, zone, _dims(spark), out, publish=True)
    assert [p.rsplit("/", 1)[-1] for p in first.processed] == ["empty_body.csv"]
    for name, schema in first.schemas.items():
        assert job.read_mart(spark, first.paths[name], schema).count() == 0
    assert {r.status for r in LG.state(LG.read(spark, first.paths["ledger"])).collect()} == {"I"}
    # Sales whose customer nobody knows: counted as lost, the marts stay empty.
    put(spark, zone, {"unknown.csv": HEADER + "99999999,1,oats,2023-05-01,1,2.00,4,8.00\n"})
    second = job.run(spark, zone, _dims(spark), out)
    assert job.read_mart(spark, second.paths["sales_mart"], second.schemas["sales_mart"]).count() == 0
    assert spark.read.parquet(second.paths["lost_sales"]).count() >= 1
    # A later file with matched rows finds nothing in its way.
    put(spark, zone, {"later.csv": HEADER + "1,1,oats,2023-05-01,1,2.00,4,8.00\n"})
    third = job.run(spark, zone, _dims(spark), out)
    assert _total(spark, third) == Decimal("8.00")


def test_extra_columns_of_any_name_keep_their_values(spark):
    from tillmart.plans.ingest import ingest

    head = HEADER.rstrip("\n")
    row = "1,1,oats,2023-05-01,1,2.00,4,8.00"
    zone = _zone(spark, {
        "a.csv": f"{head},path,note\n{row},HELLO,n\n",
        "b.csv": f"{head},file_name,_corrupt_record\n{row},F,C\n",
        "c.csv": f"{head},a`b,x.y,PATH\n{row},tick,dot,upper\n",
    })
    ing = ingest(spark, zone)
    got = {r.file_name: (r.additional_column, r.path.rsplit("/", 1)[-1]) for r in ing.rows.collect()}
    assert got == {"a.csv": ("HELLO, n", "a.csv"), "b.csv": ("F, C", "b.csv"), "c.csv": ("tick, dot, upper", "c.csv")}
    assert ing.corrupt.count() == 0


def test_moves_keep_relative_paths_and_snapshots_are_published(spark):
    from tillmart.sinks import parquet as P
    from tillmart.sources import fs

    row = "1,1,oats,2023-05-01,1,2.00,4,8.00\n"
    zone = _zone(spark, {"a/bad.csv": "a,b\n", "b/bad.csv": "a\n", "c/good.csv": HEADER + row})
    errors, done, out = (scratch_path(spark, n) for n in ("errors", "done", "run-publish"))
    result = job.run(spark, zone, _dims(spark), out, error_dir=errors, processed_dir=done, publish=True)
    assert [fs.exists(spark, f"{errors}/{d}/bad.csv") for d in "ab"] == [True, True]
    assert fs.exists(spark, f"{done}/c/good.csv") and not fs.exists(spark, f"{zone}/c/good.csv")
    base = f"{out}/published/sales_partitioned"
    assert P.latest_snapshot(spark, base) == result.paths["sales_partitioned_snapshot"] or fs.exists(spark, result.paths["sales_partitioned_snapshot"])
    assert spark.read.parquet(result.paths["sales_partitioned_snapshot"]).count() == 1
    from tillmart.operators import ledger as LG

    state = LG.state(LG.read(spark, result.paths["ledger"])).collect()
    assert all(r.updated_date > r.created_date for r in state)


def test_long_numbers_are_never_cut(spark):
    from tillmart.sources.landing_fixture import file_key
    from tillmart.sources.tables import _pad

    df = spark.sql("select 1234567890L c, 10000L p, date'2024-01-02' sales_date")
    assert df.select(_pad("c", 8).alias("x")).first().x == "1234567890"
    assert df.select(file_key(F.col("p")).alias("x")).first().x == "sales_2024_01_p10000.csv"


def test_a_shared_folder_is_required_beyond_one_machine():
    from tillmart.session import shared_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    try:
        shared_dir(Session())
        raise AssertionError("expected an error")
    except RuntimeError as e:
        assert "spark.checkpoint.dir" in str(e)
