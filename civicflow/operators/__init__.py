"""Relational operators built from DataFrame primitives (dedup, lookups,
incremental merge, type-2 history, data-quality checks, contracts)."""
