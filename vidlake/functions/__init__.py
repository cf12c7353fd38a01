"""Column-level building blocks: cleaning, derived metrics, quality rules,
feature expressions.  All are built-in Spark expressions (codegen, no UDFs)."""
