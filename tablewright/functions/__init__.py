"""Column expressions: no Python UDFs, everything stays in whole-stage codegen."""
