"""Column expressions: no jobs, no shuffles, whole-stage codegen."""
