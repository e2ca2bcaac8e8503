"""tillmart: retail sales marts as Spark DataFrame plans.

Landed CSV files are listed, their headers checked against the mandatory
columns, good files conformed to one schema, enriched with customer, store and
sales-team dimensions, and turned into detail marts, a month/store partitioned
Parquet mart, a monthly customer-spend mart and a monthly salesperson mart with
an incentive for each store's best seller.

Every step is a function from DataFrames to a DataFrame; only the modules in
``sinks`` and ``plans.job`` run actions.
"""

__version__ = "0.1.0"
