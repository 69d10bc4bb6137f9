"""Merchant-listing analytics on Spark: tables in, tables out."""
