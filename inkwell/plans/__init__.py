"""Bindings of the operators to the driver tables (see SURVEY §7.3).

``catalog.queries()`` maps a query name to ``fn(spark, sf_dir) -> DataFrame``;
``oracle.ORACLE`` holds the equivalent DuckDB SQL for the same name.
"""
