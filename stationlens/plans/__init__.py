"""Assembled jobs: fuel (fixed reference values, staging models), build (full
checkpointed build), adapters/catalog/oracle (driver queries and their DuckDB SQL)."""
