"""Dimensional modelling for wide, flat operational tables, as plain Spark DataFrame code.

``sources``    reading the flat text, landing it, writing and re-reading tables
``functions``  column expressions: tolerant parsing, blank tests, export formats
``operators``  survivors, dense ids, lookups, data-quality checks
``plans``      table definitions, model assembly, reporting queries, whole runs
"""
