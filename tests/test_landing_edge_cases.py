"""Header probe, verdicts and row quarantine on hand-written landing files.

Each file is one case from the reference's generator scripts or from the
survey's list of CSV edge cases; the provided tables cannot produce them.
"""

import os

import pytest
from pyspark.sql import functions as F

from tillmart.plans.ingest import ingest

HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"
ROW = "1,121,quaker oats,2023-05-01,1,212.00,2,424.00"

FILES = {
    "exact.csv": f"{HEADER}\n{ROW}\n",
    "extra.csv": f"{HEADER},payment_mode\n{ROW},cash\n",
    "less.csv": "customer_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,payment_mode\n"
    '1,oats,2023-05-01,"[1, 2, 3]",2.00,2,4.00,UPI\n',
    "notes.txt": "not a sales file\n",
    "empty.csv": "",
    "reordered.csv": "total_cost,quantity,price,sales_person_id,sales_date,product_name,store_id,customer_id\n"
    "424.00,2,212.00,1,2023-05-01,quaker oats,121,1\n",
    "two_extra.csv": f"{HEADER},payment_mode,coupon\n{ROW},cash,\n{ROW},,\n{ROW},UPI,SAVE5\n",
    "dup.csv": "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,Price\n"
    f"{ROW},1.00\n",
    "case.csv": HEADER.replace("store_id", "Store_ID") + f"\n{ROW}\n",
    "quoted.csv": ",".join(f'"{c}"' for c in HEADER.split(",")) + f"\n{ROW}\n",
    "bom.csv": "﻿" + HEADER + f"\n{ROW}\n",
    "bad_rows.csv": f"{HEADER}\n{ROW}\n1,121,oats,2023-05-01,1,abc,2,4.00\n1,121,oats\n{ROW},surplus\n",
    # names that URIs encode, and glob characters
    "a b+c.csv": f"{HEADER}\n{ROW}\n",
    "s[1].csv": f"{HEADER}\n{ROW}\n",
    "p%41.csv": f"{HEADER}\n{ROW}\n",
}

EXPECTED = {
    "exact.csv": ("valid", None),
    "extra.csv": ("valid", None),
    "less.csv": ("error", "missing:store_id"),
    "notes.txt": ("error", "not_csv"),
    "empty.csv": ("error", "empty"),
    "reordered.csv": ("valid", None),
    "two_extra.csv": ("valid", None),
    "dup.csv": ("error", "duplicate_header"),
    "case.csv": ("error", "missing:store_id"),
    "quoted.csv": ("valid", None),
    "bom.csv": ("valid", None),
    "bad_rows.csv": ("valid", None),
    "a b+c.csv": ("valid", None),
    "s[1].csv": ("valid", None),
    "p%41.csv": ("valid", None),
}


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("landing")
    for name, text in FILES.items():
        with open(os.path.join(d, name), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return ingest(spark, "file://" + str(d))


def test_verdicts(landed):
    got = {r.file_name: (r.verdict, r.reason) for r in landed.verdicts.collect()}
    assert got == EXPECTED


def test_extra_columns_in_header_order(landed):
    extras = {r.file_name: list(r.extra or []) for r in landed.verdicts.collect()}
    assert extras["two_extra.csv"] == ["payment_mode", "coupon"]
    assert extras["exact.csv"] == []


def test_additional_column_skips_nulls(landed):
    rows = landed.rows.where("file_name = 'two_extra.csv'").select("additional_column").collect()
    assert sorted(r.additional_column for r in rows) == ["", "UPI, SAVE5", "cash"]
    exact = landed.rows.where("file_name = 'exact.csv'").collect()
    assert [r.additional_column for r in exact] == [None]


def test_values_bound_by_name(landed):
    r = landed.rows.where("file_name = 'reordered.csv'").collect()[0]
    assert (r.customer_id, r.store_id, r.quantity, str(r.total_cost)) == (1, 121, 2, "424.00")


def test_bad_rows_are_quarantined(landed):
    bad = landed.corrupt.where("file_name = 'bad_rows.csv'").count()
    good = landed.rows.where("file_name = 'bad_rows.csv'").count()
    assert (good, bad) == (1, 3)


def test_bad_rows_name_their_column_and_reason(spark, tmp_path):
    d = tmp_path / "reasons"
    d.mkdir()
    lines = {
        "1,121,oats,2023-05-01,1,abc,2,4.00": ("price", "not decimal"),
        "x,121,oats,2023-05-01,1,2.00,y,4.00": ("customer_id", "not long"),  # the first of two
        "1,121,oats,2023-13-01,1,2.00,2,4.00": ("sales_date", "not date"),
        "1,121,oats,2023-05-01,1,2.00,2.0,4.00": ("quantity", "not integer"),
        "1,121,oats,2023-05-01,1,2.00,2,4.005": ("total_cost", "inexact amount"),
        '1,121,"oats, rolled",2023-05-01,1,2.005,2,4.00': ("price", "inexact amount"),
        "1,121,oats": (None, "field count"),
        f"{ROW},surplus": (None, "field count"),
        ",,,,,,,z": ("total_cost", "not decimal"),
    }
    (d / "a.csv").write_text("\n".join([HEADER, ROW, *lines, ROW]) + "\n")
    # the same faults under another order of columns, and a quoted line break
    (d / "b.csv").write_text("quantity,price,total_cost,customer_id,store_id,product_name,sales_date,sales_person_id,note\n"
                             "2,2.00,4.00,1,121,oats,2023-05-01,one,n\n2,2.00,4.00,1,121,\"oa\nts\",2023-05-01,1,n\n")
    got = ingest(spark, "file://" + str(d))
    bad = {r.record: (r.bad_column, r.reason) for r in got.corrupt.where("file_name = 'a.csv'").collect()}
    assert bad == lines
    other = sorted((r.record, r.bad_column, r.reason) for r in got.corrupt.where("file_name = 'b.csv'").collect())
    assert [(c, r) for _, c, r in other] == [(None, "field count"), ("sales_person_id", "not long"), (None, "field count")]
    assert got.rows.count() == 2


def test_many_headers_take_several_projections(spark, tmp_path, monkeypatch):
    from tillmart.sources import landing as L

    monkeypatch.setattr(L, "HEADERS_PER_SCAN", 3)
    d = tmp_path / "headers"
    d.mkdir()
    for i in range(8):
        (d / f"{i}.csv").write_text(f"{HEADER},x{i}\n{ROW},v{i}\n")
    rows = ingest(spark, "file://" + str(d)).rows.collect()
    assert {r.file_name: r.additional_column for r in rows} == {f"{i}.csv": f"v{i}" for i in range(8)}


def test_landed_files_are_scanned_once(spark, tmp_path, monkeypatch):
    """One text scan is all that reads the landed files; every later plan reads Parquet."""
    from tillmart.sources import landing as L

    d = tmp_path / "once"
    d.mkdir()
    (d / "a.csv").write_text(f"{HEADER}\n{ROW}\n")
    (d / "less.csv").write_text("customer_id\n1\n")
    scans, plans = [], []
    monkeypatch.setattr(L, "stage_lines", lambda *a, f=L.stage_lines: scans.append(a[1]) or f(*a))
    monkeypatch.setattr(L, "parse_lines", lambda *a, f=L.parse_lines: plans.append(f(*a)) or plans[-1])
    got = ingest(spark, "file://" + str(d))
    assert [len(s) for s in scans] == [2]
    for df in (*plans, got.rows, got.lines, got.verdicts):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "FileScan csv" not in plan and "FileScan text" not in plan


def test_quoted_and_bom_headers_parse(landed):
    assert landed.rows.where("file_name in ('quoted.csv', 'bom.csv')").count() == 2


def test_file_spanning_many_splits(spark, tmp_path):
    """Header from the first split only; every split parsed, no line lost."""
    d = tmp_path / "big"
    d.mkdir()
    n = 60_000
    with open(d / "big.csv", "w") as f:
        f.write(HEADER + ",payment_mode\n")
        for i in range(n):
            f.write(f"{i},121,oats,2023-05-01,{i % 7},2.00,{1 + i % 9},{2 * (1 + i % 9)}.00,cash\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(256 * 1024))  # about 12 splits
    try:
        assert spark.read.text("file://" + str(d)).rdd.getNumPartitions() > 4
        ing = ingest(spark, "file://" + str(d))
        v = ing.verdicts.collect()
        assert [(r.file_name, r.verdict, list(r.extra)) for r in v] == [("big.csv", "valid", ["payment_mode"])]
        assert ing.rows.count() == n and ing.corrupt.count() == 0
        assert ing.rows.agg({"customer_id": "sum"}).first()[0] == n * (n - 1) // 2
    finally:
        spark.conf.set(key, before)


def test_special_file_names_keep_their_rows(landed):
    names = ["a b+c.csv", "s[1].csv", "p%41.csv"]
    got = {r.file_name: r.n for r in landed.rows.where(F.col("file_name").isin(names)).groupBy("file_name")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {n: 1 for n in names}


def test_listing_lengths_and_names(spark, tmp_path):
    from tillmart.sources import landing as L

    d = tmp_path / "zone"
    d.mkdir()
    files = {"plain.csv": "x\n", "a b+c{1}*?.csv": "yy\n", "empty.csv": "", "notes.txt": "zzz\n"}
    for name, text in files.items():
        (d / name).write_text(text)
    got = {r.file_name: (r.is_csv, r.length) for r in L.list_files(spark, "file://" + str(d)).collect()}
    assert got == {n: (n.endswith(".csv"), len(t.encode())) for n, t in files.items()}
    listed = L.list_files(spark, "file://" + str(d)).collect()
    # every listed path reads back its own file, glob characters included
    for r in listed:
        if r.length:
            text = [x.value for x in spark.read.text(L.reader_path(r.path)).collect()]
            assert text == [files[r.file_name].rstrip("\n")]
    assert L.canonical("file:///x/a%20b%2B%5B1%5D.csv", encoded=True) == "file:/x/a b+[1].csv"
