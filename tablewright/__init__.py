"""Relational data work on Spark DataFrames.

Joins, aggregates, rankings, set operations, subquery predicates, table changes,
integrity checks, schema changes, views and materialized views, each written as a
plain DataFrame plan that keeps its shape when the tables grow.
"""
