"""Column expressions; all built in, so they stay inside whole-stage code generation."""
