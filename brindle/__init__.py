"""Brindle: log, visit and sales analytics as composable Spark DataFrame jobs.

Layout
------
``sources``    readers and parsers (text, JSON, visit log, access log, tables)
``sinks``      writers and table maintenance
``functions``  column expressions
``operators``  DataFrame -> DataFrame building blocks
``plans``      plan text, scoped settings, size checks, shared work folder
``catalog``    the named queries with the SQL each one is checked against
"""
