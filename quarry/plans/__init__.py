"""Bindings of the operators to the shared test tables.

``queries.QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame`` and
``oracles.ORACLES`` maps the same name to DuckDB SQL over the same parquet
files. ``__spark_entry__`` only wires these two dictionaries.
"""
