"""Column expressions (dates, conditionals) and schema-level helpers."""
