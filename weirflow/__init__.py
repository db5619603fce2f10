"""Spark-native incremental refinement and customer analytics.

Layout
------
functions   column expressions: client rules, dates, schema-driven conversions, codecs
operators   DataFrame operators: newest version, increments, joins, nesting, shares, trees, text
sources     readers and writers
plans       composite jobs and reports made from the operators
streaming   Structured Streaming ingest and upsert
catalog     the registered queries and the SQL they are checked against
"""
