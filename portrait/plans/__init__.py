"""Bindings of the operators to the driver's test tables.

``queries.QUERIES`` maps a query key to ``f(spark, sf_dir) -> DataFrame``;
``oracle.ORACLE_SQL`` holds the same computation as DuckDB SQL.
"""
