"""Claims of files by runs at the same time."""

import datetime as dt
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from conftest import SF_SMALL
from tillmart.operators import claims as CL
from tillmart.operators import ledger as LG
from tillmart.plans import job
from tillmart.session import run_all, scratch_path
from tillmart.sources import fs
from tillmart.sources.landing_fixture import landing_for
from tillmart.sources.tables import RetailInputs


def pending(spark, *names):
    return lambda: spark.createDataFrame([(n, 1, False) for n in names], "path string, length long, seen boolean")


def paths(df):
    return sorted(r.path for r in df.select("path").collect())


def test_a_name_is_created_once(spark):
    target = f"{scratch_path(spark, 'create-new')}/000000000001"
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda i: fs.create_new(spark, target, f"state {i} " + "x" * 1000), range(32)))
    assert won.count(True) == 1
    assert fs.read_text(spark, target).startswith(f"state {won.index(True)} x")
    assert len(fs.list_dir(spark, target.rsplit("/", 1)[0])) == 1  # no drafts left


def test_claims_never_overlap(spark):
    base = scratch_path(spark, "claims")
    got = {}
    names = [f"f{i:02d}" for i in range(12)]
    run_all(*[lambda b=b: got.update({b: paths(CL.claim(spark, base, b, pending(spark, *names), max_files=5))}) for b in ("b1", "b2", "b3")])
    taken = sorted(p for ps in got.values() for p in ps)
    assert taken == names and sorted(map(len, got.values())) == [2, 5, 5]
    assert paths(CL.claim(spark, base, "b4", pending(spark, *names))) == []
    CL.release(spark, base, "b1")
    assert paths(CL.claim(spark, base, "b5", pending(spark, *names))) == got["b1"]
    assert {r.batch for r in CL.held_files(spark, base).collect()} == {"b2", "b3", "b5"}


def test_a_dead_run_loses_its_claim(spark):
    base = scratch_path(spark, "claims-lease")
    CL.claim(spark, base, "dead", pending(spark, "a"), lease_s=1)
    with pytest.raises(CL.ClaimLost), CL.section(spark, base, "dead", lease_s=1):
        assert paths(CL.claim(spark, base, "early", pending(spark, "a", "b"))) == ["b"]
        time.sleep(1.5)
        assert paths(CL.claim(spark, base, "next", pending(spark, "a", "b"))) == ["a"]
        with CL.section(spark, base, "next"):  # the dead run is no longer inside
            CL.check_held(spark, base, "next")
            CL.check_held(spark, base, "dead")
    with pytest.raises(CL.ClaimLost), CL.section(spark, base, "dead"):
        pass


def test_one_run_inside_at_a_time(spark):
    base, log = scratch_path(spark, "claims-section"), []

    def inside(batch):
        CL.claim(spark, base, batch, pending(spark, batch))
        with CL.section(spark, base, batch):
            log.append(("in", batch))
            time.sleep(0.3)
            log.append(("out", batch))

    run_all(*[lambda b=b: inside(b) for b in ("x", "y", "z")])
    assert [b for _, b in log[::2]] == [b for _, b in log[1::2]] and [k for k, _ in log] == ["in", "out"] * 3


def test_two_runs_at_once_count_every_file_once(spark, monkeypatch):
    landing = landing_for(spark, SF_SMALL)
    r = RetailInputs(spark, SF_SMALL)
    dims = job.Dimensions(r.customer(), r.store(), r.sales_team())
    whole = job.run(spark, landing, dims, scratch_path(spark, "claims-whole"), now=dt.datetime(2024, 6, 1))
    out, found = scratch_path(spark, "claims-runs"), []
    half = len(whole.processed + whole.rejected) // 2 + 1
    run_all(*[lambda: found.append(job.run(spark, landing, dims, out, now=dt.datetime(2024, 6, 1), max_files=half)) for _ in range(2)])
    assert sorted(found[0].processed + found[1].processed) == sorted(whole.processed)
    closings = [e.file_location for e in LG.read(spark, found[0].paths["ledger"]).where("status = 'I'").collect()]
    assert sorted(closings) == sorted(whole.processed)
    for mart in ("sales_mart", "customer_mart", "sales_partitioned"):
        want = sorted(map(tuple, job.read_mart(spark, whole.paths[mart]).collect()))
        assert sorted(map(tuple, job.read_mart(spark, found[0].paths[mart]).collect())) == want
    assert CL.held_files(spark, f"{out}/claims").count() == 0


def test_a_failed_run_gives_its_files_back(spark, monkeypatch):
    landing = landing_for(spark, SF_SMALL)
    out = scratch_path(spark, "claims-failed")

    def fail(*_, **__):
        raise RuntimeError("parse failed")

    with monkeypatch.context() as m:
        m.setattr(job, "ingest", fail)
        with pytest.raises(RuntimeError, match="parse failed"):
            job.run(spark, landing, None, out, now=dt.datetime(2024, 6, 2))
    assert CL.held_files(spark, f"{out}/claims").count() == 0
