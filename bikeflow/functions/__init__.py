"""Column expressions: no data movement, everything stays in whole-stage codegen."""
