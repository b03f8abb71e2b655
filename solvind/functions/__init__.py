"""Column expressions. No UDFs: everything here stays inside whole-stage codegen."""
