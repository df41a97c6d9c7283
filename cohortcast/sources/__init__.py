"""Inputs: catalog/parquet tables, stand-ins from the test tables, CSV files."""

from cohortcast.sources.tables import (Sources, from_catalog, load_sql, load_sql_file, read_legacy,
                                       read_table, run_script, set_variables)

__all__ = ["Sources", "from_catalog", "load_sql", "load_sql_file", "read_legacy", "read_table",
           "run_script", "set_variables"]
