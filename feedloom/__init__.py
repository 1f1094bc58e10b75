"""Landed feed documents and archives turned into clean tables with Spark DataFrames."""
