"""Subscription-revenue analytics on Spark.

Five raw tables in, audited clean tables, feature tables, a monthly revenue
ledger, metric reports and data-quality reports out.  Every operator is a
function from DataFrames to a DataFrame and runs no action of its own unless
its docstring says so.
"""
