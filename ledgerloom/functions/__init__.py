"""Column expressions. Everything here is a Spark built-in, so it stays in codegen."""
