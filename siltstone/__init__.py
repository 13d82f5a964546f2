"""Layered (raw, silver, gold) batch analytics written for Spark DataFrames."""
