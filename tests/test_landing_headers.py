"""Header shapes that a CSV reader accepts, and amounts that are not rounded."""

from decimal import Decimal

from test_invariants import HEADER, _zone

from tillmart.plans.ingest import ingest

ROW = "1,1,oats,2023-05-01,1,2.00,4,8.00"


def test_header_shapes(spark):
    names = HEADER.strip()
    files = {
        "blank.csv": f"\n{names}\n{ROW}\n",
        "twice.csv": f"{names},note,note\n{ROW},x,y\n",
        "quoted.csv": f'{names},"note, extra"\n{ROW},z\n',
        "mandatory_twice.csv": f"{names},store_id\n{ROW},1\n",
    }
    got = ingest(spark, _zone(spark, files))
    verdicts = {r.file_name: (r.verdict, list(r.extra)) for r in got.verdicts.collect()}
    assert verdicts == {
        "blank.csv": ("valid", []),
        "twice.csv": ("valid", ["note8", "note9"]),
        "quoted.csv": ("valid", ["note, extra"]),
        "mandatory_twice.csv": ("error", []),
    }
    rows = {r.file_name: r.additional_column for r in got.rows.collect()}
    assert rows == {"blank.csv": None, "twice.csv": "x, y", "quoted.csv": "z"}
    assert got.corrupt.count() == 0


def test_inexact_amounts_are_quarantined(spark):
    bad = ["1,1,oats,2023-05-01,1,2.005,4,8.00", "1,1,oats,2023-05-01,1,2.00,4,4.015", "1,1,oats,2023-05-01,1,2.00,2.0,8.00"]
    got = ingest(spark, _zone(spark, {"a.csv": HEADER + "\n".join([ROW, "1,1,oats,2023-05-01,1,2.500,4,8", *bad]) + "\n"}))
    assert sorted(r.price for r in got.rows.collect()) == [Decimal("2.00"), Decimal("2.50")]
    assert got.corrupt.count() == 3
