"""Equivalent ANSI SQL (DuckDB dialect) for each registered query.

The provided tables are pre-registered as views.  The common table
expressions below restate the fixture mapping (sales fact, three dimensions,
enriched join) in SQL; each query then states the reference's semantics the
direct way (window sum + DISTINCT, rank() = 1), independently of how the Spark
side computes them.
"""

from __future__ import annotations

BASE = """
WITH sales AS (
  SELECT o.o_custkey AS customer_id,
         s.s_nationkey AS store_id,
         p.p_name AS product_name,
         CAST(o.o_orderdate AS DATE) AS sales_date,
         l.l_suppkey AS sales_person_id,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS price,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_cost
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
customer_dim AS (
  SELECT c.c_custkey AS customer_id,
         split_part(c.c_name, '#', 1) AS first_name,
         split_part(c.c_name, '#', 2) AS last_name,
         n.n_name AS address,
         lpad(CAST(c.c_nationkey AS VARCHAR), CAST(greatest(6, length(CAST(c.c_nationkey AS VARCHAR))) AS INTEGER), '0') AS pincode,
         '91' || lpad(CAST(c.c_custkey AS VARCHAR), CAST(greatest(8, length(CAST(c.c_custkey AS VARCHAR))) AS INTEGER), '0') AS phone_number,
         DATE '2020-01-01' AS customer_joining_date
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
store_dim AS (
  SELECT n_nationkey AS id,
         n_name AS address,
         lpad(CAST(n_regionkey AS VARCHAR), CAST(greatest(6, length(CAST(n_regionkey AS VARCHAR))) AS INTEGER), '0') AS store_pincode,
         'Manager ' || n_name AS store_manager_name,
         DATE '2020-01-01' AS store_opening_date,
         CAST(NULL AS VARCHAR) AS reviews
  FROM nation
),
team_base AS (
  SELECT s.s_suppkey, s.s_name, s.s_nationkey, n.n_name,
         MIN(s.s_suppkey) OVER (PARTITION BY s.s_nationkey) AS manager_id
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
),
sales_team_dim AS (
  SELECT s_suppkey AS id,
         split_part(s_name, '#', 1) AS first_name,
         split_part(s_name, '#', 2) AS last_name,
         manager_id,
         CASE WHEN s_suppkey = manager_id THEN 'Y' ELSE 'N' END AS is_manager,
         n_name AS address,
         lpad(CAST(s_nationkey AS VARCHAR), CAST(greatest(6, length(CAST(s_nationkey AS VARCHAR))) AS INTEGER), '0') AS pincode,
         DATE '2020-01-01' AS joining_date
  FROM team_base
),
enriched AS (
  SELECT f.customer_id, f.store_id, f.sales_date, f.sales_person_id, f.total_cost,
         c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
         s.address AS store_address, s.store_manager_name,
         t.first_name AS sales_person_first_name,
         t.last_name AS sales_person_last_name,
         t.address AS sales_person_address,
         t.pincode AS sales_person_pincode,
         t.joining_date AS sales_person_joining_date,
         t.manager_id, t.is_manager
  FROM sales f
  JOIN customer_dim c ON f.customer_id = c.customer_id
  JOIN store_dim s ON f.store_id = s.id
  JOIN sales_team_dim t ON f.sales_person_id = t.id
),
team_detail AS (
  SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name,
         store_manager_name, manager_id, is_manager, sales_person_address,
         sales_person_pincode, sales_date, total_cost,
         strftime(sales_date, '%Y-%m') AS sales_month
  FROM enriched
),
team_totals AS (
  SELECT DISTINCT store_id, sales_person_id,
         sales_person_first_name || ' ' || sales_person_last_name AS full_name,
         sales_month,
         CAST(SUM(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month)
              AS DECIMAL(18,2)) AS total_sales
  FROM team_detail
),
team_ranked AS (
  SELECT *, CAST(RANK() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC)
                 AS INTEGER) AS rnk
  FROM team_totals
),
customer_mart AS (
  SELECT DISTINCT customer_id, first_name || ' ' || last_name AS full_name,
         address, phone_number, strftime(sales_date, '%Y-%m') AS sales_date_month,
         CAST(SUM(total_cost) OVER (PARTITION BY customer_id, strftime(sales_date, '%Y-%m'))
              AS DECIMAL(18,2)) AS total_sales
  FROM enriched
)
"""


def _q(body: str) -> str:
    return BASE + body


INCENTIVE_EXPR = (
    "CAST(CASE WHEN rnk = 1 THEN ROUND(total_sales * 0.01, 2) ELSE 0 END AS DECIMAL(18,2))"
)

ORACLE: dict[str, str] = {
    "enriched_sales": _q("SELECT * FROM enriched"),
    "sales_monthly_totals": _q("SELECT * FROM team_totals"),
    "sales_rank": _q("SELECT * FROM team_ranked"),
    "incentive": _q(
        f"""SELECT store_id, sales_person_id, sales_month, total_sales,
                   rnk = 1 AS is_top, {INCENTIVE_EXPR} AS incentive
            FROM team_ranked"""
    ),
    "sales_incentive_mart": _q(
        f"""SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
                   {INCENTIVE_EXPR} AS incentive
            FROM team_ranked"""
    ),
    "customer_monthly_mart": _q("SELECT * FROM customer_mart"),
    "customer_monthly_window": _q(
        """SELECT customer_id, sales_date, total_cost,
                  strftime(sales_date, '%Y-%m') AS sales_date_month,
                  CAST(SUM(total_cost) OVER (PARTITION BY customer_id, strftime(sales_date, '%Y-%m'))
                       AS DECIMAL(18,2)) AS total_sales_every_month_by_each_customer
           FROM enriched"""
    ),
    "sales_monthly_window": _q(
        """SELECT store_id, sales_person_id, sales_month, sales_date, total_cost,
                  CAST(SUM(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month)
                       AS DECIMAL(18,2)) AS total_sales_every_month
           FROM team_detail"""
    ),
    "sales_month": _q(
        """SELECT substring(CAST(sales_date AS VARCHAR), 1, 7) AS sales_month,
                  COUNT(*) AS n_rows, CAST(SUM(total_cost) AS DECIMAL(18,2)) AS total_sales
           FROM enriched GROUP BY 1"""
    ),
    "full_name": _q(
        "SELECT DISTINCT customer_id, first_name || ' ' || last_name AS full_name FROM enriched"
    ),
    "top_sellers": _q(
        "SELECT store_id, sales_person_id, full_name, sales_month, total_sales FROM team_ranked WHERE rnk = 1"
    ),
    "distinct_sales_keys": _q("SELECT DISTINCT store_id, sales_person_id, sales_month FROM team_detail"),
    "unmatched_sales": _q(
        """, lost AS (
             SELECT CASE WHEN c.customer_id IS NULL THEN 'customer'
                         WHEN s.id IS NULL THEN 'store'
                         WHEN t.id IS NULL THEN 'sales_team' END AS dimension,
                    CASE WHEN c.customer_id IS NULL THEN f.customer_id
                         WHEN s.id IS NULL THEN CAST(f.store_id AS BIGINT)
                         ELSE f.sales_person_id END AS dim_key,
                    f.total_cost
             FROM sales f
             LEFT JOIN (SELECT d.* FROM customer_dim d JOIN customer ON c_custkey = customer_id
                        WHERE c_acctbal >= 0) c ON f.customer_id = c.customer_id
             LEFT JOIN (SELECT d.* FROM store_dim d JOIN nation ON n_nationkey = id
                        JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'MIDDLE EAST') s ON f.store_id = s.id
             LEFT JOIN (SELECT d.* FROM sales_team_dim d JOIN supplier ON s_suppkey = id
                        WHERE s_acctbal >= 0) t ON f.sales_person_id = t.id
           )
           SELECT dimension, dim_key, COUNT(*) AS n_rows,
                  CAST(SUM(total_cost) AS DECIMAL(18,2)) AS lost_total
           FROM lost WHERE dimension IS NOT NULL GROUP BY dimension, dim_key"""
    ),
    "mart_conformed": _q(
        """SELECT customer_id, full_name, address, phone_number,
                  CAST(sales_date_month || '-01' AS DATE) AS sales_date_month,
                  total_sales
           FROM customer_mart"""
    ),
    "customer_detail_mart": _q(
        """SELECT customer_id, first_name, last_name, address, pincode, phone_number,
                  sales_date, total_cost FROM enriched"""
    ),
    "sales_team_detail_mart": _q("SELECT * FROM team_detail"),
    "partitioned_mart": _q("SELECT * FROM team_detail"),
    "partition_pruned_read": _q(
        "SELECT * FROM team_detail WHERE sales_month BETWEEN '1998-01' AND '1998-12'"
    ),
    "partitioned_snapshot": _q("SELECT * FROM team_detail"),
    "snapshot_mart": _q(
        f"""SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
                   {INCENTIVE_EXPR} AS incentive
            FROM team_ranked"""
    ),
}


# --- landing zone (steps 4-6) ----------------------------------------------------
# The landed files are restated from the fixture rule in landing_fixture: a
# sales month in ceil(rows / ROWS_PER_FILE) files, part = (l_orderkey +
# l_linenumber) % parts, header shape = (year * 12 + month) % 5.

from tillmart.schemas import MANDATORY_COLUMNS  # noqa: E402
from tillmart.sources import landing_fixture as LF  # noqa: E402


def _sql_str(v):
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def _shape_table() -> str:
    rows = []
    for shape, header in LF.SHAPE_HEADERS.items():
        missing = [c for c in MANDATORY_COLUMNS if c not in header]
        extra = [c for c in header if c not in MANDATORY_COLUMNS]
        reason = "missing:" + ",".join(missing) if missing else None
        rows.append(
            f"({shape}, {_sql_str(','.join(header))}, {_sql_str(','.join(missing))}, {len(missing)}, "
            f"{_sql_str(','.join(extra))}, {len(extra)}, {_sql_str('error' if missing else 'valid')}, "
            f"{_sql_str(reason)})"
        )
    return (
        "SELECT * FROM (VALUES " + ", ".join(rows) + ") "
        "AS t(shape, header, missing, n_missing, extra, n_extra, verdict, reason)"
    )


def landed_ctes(rows_per_file: int = LF.ROWS_PER_FILE) -> str:
    """CTEs ``landed``, ``shapes``, ``files``, ``landed_rows`` for a landing
    zone written with ``rows_per_file``."""
    return LANDED_TEMPLATE.replace("{rows_per_file}", str(int(rows_per_file)))


LANDED_TEMPLATE = f"""
, keyed AS (
  SELECT o.o_custkey AS customer_id,
         s.s_nationkey AS store_id,
         p.p_name AS product_name,
         CAST(o.o_orderdate AS DATE) AS sales_date,
         l.l_suppkey AS sales_person_id,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS price,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_cost,
         l.l_orderkey + l.l_linenumber AS spread
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
parted AS (
  SELECT *, spread % CAST(ceil(COUNT(*) OVER (PARTITION BY strftime(sales_date, '%Y_%m'))
                               / {{rows_per_file}}) AS BIGINT) AS part
  FROM keyed
),
landed AS (
  SELECT * EXCLUDE (spread, part),
         'sales_' || strftime(sales_date, '%Y_%m') || '_p' || lpad(CAST(part AS VARCHAR), CAST(greatest(4, length(CAST(part AS VARCHAR))) AS INTEGER), '0')
           || '.csv' AS file_name,
         (year(sales_date) * 12 + month(sales_date)) % {LF.N_SHAPES} AS shape,
         CASE WHEN quantity % 2 = 0 THEN 'cash' ELSE 'UPI' END AS payment_mode,
         CASE WHEN quantity % 3 = 0 THEN 'SAVE' || CAST(quantity AS VARCHAR) END AS coupon
  FROM parted
),
shapes AS ({_shape_table()}),
files AS (SELECT DISTINCT file_name, shape, CAST(substring(file_name, 7, 4) AS INTEGER) AS yr FROM landed),
landed_rows AS (
  SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity,
         total_cost,
         CASE shape WHEN 0 THEN CAST(NULL AS VARCHAR)
                    WHEN 1 THEN payment_mode
                    ELSE concat_ws(', ', payment_mode, coupon) END AS additional_column,
         file_name
  FROM landed
  WHERE shape IN {tuple(LF.VALID_SHAPES)} AND NOT (shape = 0 AND quantity = {LF.BAD_QUANTITY})
)
"""


# Query bodies over the landing CTEs, by query key.
LANDING_BODIES = {
        "landing_listing": (
            f"""SELECT file_name, true AS is_csv FROM files
                UNION ALL SELECT '{LF.NOTES_FILE}', false
                UNION ALL SELECT '{LF.EMPTY_FILE}', true"""
        ),
        "header_probe": (
            f"""SELECT f.file_name, s.header FROM files f JOIN shapes s USING (shape)
                UNION ALL SELECT '{LF.EMPTY_FILE}', NULL"""
        ),
        "missing_columns": (
            "SELECT f.file_name, s.missing, CAST(s.n_missing AS INTEGER) AS n_missing "
            "FROM files f JOIN shapes s USING (shape)"
        ),
        "extra_columns": (
            "SELECT f.file_name, s.extra, CAST(s.n_extra AS INTEGER) AS n_extra "
            "FROM files f JOIN shapes s USING (shape)"
        ),
        "file_verdicts": (
            f"""SELECT f.file_name, s.verdict, s.reason FROM files f JOIN shapes s USING (shape)
                UNION ALL SELECT '{LF.NOTES_FILE}', 'error', 'not_csv'
                UNION ALL SELECT '{LF.EMPTY_FILE}', 'error', 'empty'"""
        ),
        "quarantine_rows": (
            f"""SELECT l.file_name, s.reason, COUNT(*) + 1 AS n_lines
                FROM landed l JOIN shapes s USING (shape) WHERE s.verdict = 'error'
                GROUP BY l.file_name, s.reason
                UNION ALL SELECT '{LF.NOTES_FILE}', 'not_csv',
                    (SELECT COUNT(DISTINCT strftime(sales_date, '%Y-%m')) FROM landed)
                UNION ALL SELECT '{LF.EMPTY_FILE}', 'empty', 0"""
        ),
        "corrupt_rows": (
            f"""SELECT file_name, 'quantity' AS bad_column, 'not integer' AS reason, COUNT(*) AS n_rows FROM landed
                WHERE shape = 0 AND quantity = {LF.BAD_QUANTITY} GROUP BY file_name"""
        ),
        "additional_column": (
            "SELECT file_name, additional_column, COUNT(*) AS n_rows FROM landed_rows "
            "GROUP BY file_name, additional_column"
        ),
        "csv_ingest_unified": ("SELECT * FROM landed_rows"),
        "empty_input": ("SELECT * FROM landed_rows WHERE false"),
        "ledger_state": (
            """SELECT f.file_name,
                      CASE WHEN f.yr < 2000 THEN 'I' ELSE 'A' END AS status,
                      CASE WHEN f.yr < 2000 THEN TIMESTAMP '2024-01-01 00:00:00'
                           ELSE TIMESTAMP '2024-01-02 00:00:00' END AS created_date,
                      CASE WHEN f.yr < 2000 THEN TIMESTAMP '2024-01-01 01:00:00' END AS updated_date
               FROM files f JOIN shapes s USING (shape) WHERE s.verdict = 'valid'"""
        ),
        "active_files": (
            """SELECT f.file_name FROM files f JOIN shapes s USING (shape)
               WHERE s.verdict = 'valid' AND f.yr >= 2000"""
        ),
        "pending_files": (
            f"""SELECT f.file_name FROM files f JOIN shapes s USING (shape)
                WHERE NOT (s.verdict = 'valid' AND f.yr < 2000)
                UNION ALL SELECT '{LF.EMPTY_FILE}'"""
        ),
}


def _landed_chain() -> str:
    """The enriched -> ranked CTE chain of BASE, fed by the landed rows."""
    start, end = BASE.index("enriched AS ("), BASE.index("customer_mart AS (")
    chain = BASE[start:end].rstrip().rstrip(",")
    for name in ("team_ranked", "team_totals", "team_detail", "enriched"):
        chain = chain.replace(name, "l_" + name)
    return ", " + chain.replace("FROM sales f", "FROM landed_rows f") + "\n"


LANDING_BODIES.update(
    {
        "end_to_end_run": (
            _landed_chain()
            + """SELECT store_id, sales_person_id, full_name, sales_month,
                        total_sales,
                        CAST(CASE WHEN rnk = 1 THEN ROUND(total_sales * 0.01, 2) ELSE 0 END
                             AS DECIMAL(18,2)) AS incentive
                 FROM l_team_ranked"""
        ),
        "run_customer_mart": (
            _landed_chain()
            + """SELECT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
                        CAST(strftime(sales_date, '%Y-%m') || '-01' AS DATE) AS sales_date_month,
                        CAST(SUM(total_cost) AS DECIMAL(18,2)) AS total_sales
                 FROM l_enriched GROUP BY ALL"""
        ),
        "run_quarantine": LANDING_BODIES["quarantine_rows"],
        "stream_file_ingest": "SELECT * FROM landed_rows",
        "published_marts": (
            _landed_chain()
            + """SELECT store_id, sales_person_id, sales_month, CAST(SUM(total_cost) AS DECIMAL(18,2)) AS total_sales,
                        COUNT(*) AS n_rows
                 FROM l_team_detail GROUP BY ALL"""
        ),
        "stream_monthly_totals": (
            _landed_chain() + "SELECT store_id, sales_person_id, full_name, sales_month, total_sales FROM l_team_totals"
        ),
    }
)
LANDING_BODIES["concurrent_runs"] = LANDING_BODIES["end_to_end_run"]


def landing_sql(name: str, rows_per_file: int = LF.ROWS_PER_FILE) -> str:
    """Oracle SQL of landing query ``name`` for a zone of ``rows_per_file``."""
    return BASE + landed_ctes(rows_per_file) + LANDING_BODIES[name]


ORACLE.update({name: landing_sql(name) for name in LANDING_BODIES})
