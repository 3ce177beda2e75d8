"""Keyed-document analytics on Spark: tables with hash and range keys, nested items, any SQL."""
