"""The registered queries: one per operator, bound to views of the given tables, with DuckDB SQL to compare."""
