"""Column functions: each takes and returns Column expressions, so they stay inside codegen."""
