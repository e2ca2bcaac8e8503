"""Fixed column lists and explicit schemas.

Nothing here is inferred: every table has one ``StructType``, and CSV scans
build theirs from each file's own header order (see ``sources.landing``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's configuration) -----------------
# Mandatory landing columns, in the reference's order.
MANDATORY_COLUMNS = [
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
]
# Separator used when surplus columns are folded into one.
EXTRA_SEPARATOR = ", "
# Share of a month's sales paid to the store's best seller.
INCENTIVE_RATE = "0.01"
# Ledger status codes: A = file taken up by a run, I = file fully processed.
STATUS_ACTIVE = "A"
STATUS_INACTIVE = "I"
# Columns of the enriched sales and of the two detail marts.
ENRICHED_COLUMNS = [
    "customer_id",
    "store_id",
    "sales_date",
    "sales_person_id",
    "total_cost",
    "first_name",
    "last_name",
    "address",
    "pincode",
    "phone_number",
    "store_address",
    "store_manager_name",
    "sales_person_first_name",
    "sales_person_last_name",
    "sales_person_address",
    "sales_person_pincode",
    "sales_person_joining_date",
    "manager_id",
    "is_manager",
]
CUSTOMER_DETAIL_COLUMNS = [
    "customer_id",
    "first_name",
    "last_name",
    "address",
    "pincode",
    "phone_number",
    "sales_date",
    "total_cost",
]
SALES_TEAM_DETAIL_COLUMNS = [
    "store_id",
    "sales_person_id",
    "sales_person_first_name",
    "sales_person_last_name",
    "store_manager_name",
    "manager_id",
    "is_manager",
    "sales_person_address",
    "sales_person_pincode",
    "sales_date",
    "total_cost",
]
# -----------------------------------------------------------------------------

ADDITIONAL_COLUMN = "additional_column"

MONEY = T.DecimalType(18, 2)
MART_MONEY = T.DecimalType(10, 2)
# Money as read from a file, before it is checked to have at most two places.
READ_MONEY = T.DecimalType(38, 18)

# Types of the mandatory columns when read from a landing CSV.  Keys are wide
# (long) so that the provided test tables and real landing files share them.
LANDING_TYPES: dict[str, T.DataType] = {
    "customer_id": T.LongType(),
    "store_id": T.IntegerType(),
    "product_name": T.StringType(),
    "sales_date": T.DateType(),
    "sales_person_id": T.LongType(),
    "price": MONEY,
    "quantity": T.IntegerType(),
    "total_cost": MONEY,
}

SALES_SCHEMA = T.StructType(
    [T.StructField(c, LANDING_TYPES[c], True) for c in MANDATORY_COLUMNS]
    + [T.StructField(ADDITIONAL_COLUMN, T.StringType(), True)]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType(), False),
        T.StructField("file_location", T.StringType(), True),
        T.StructField("event_ts", T.TimestampType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("batch", T.StringType(), True),  # the run that wrote the file's rows
    ]
)
