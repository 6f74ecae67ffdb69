"""DuckDB SQL that states what each query must return."""
