"""quarry: DataFrame-first analytics operators on PySpark.

Every operator takes DataFrames plus parameters and returns a DataFrame, so
the work stays inside one Catalyst plan until the caller acts on it.

Sub-packages
------------
sources    file and table readers (CSV, text lines, ``::`` records, ragged lines)
sinks      line renderers and writers
functions  column-expression helpers (presence, keyed split, list rendering)
operators  relational core, recommenders, market baskets, clustering, min-hash/LSH
plans      bindings of the operators to the shared test tables, plus DuckDB oracles
api        file-level functions with the original exercises' names and arguments
"""

from quarry.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
