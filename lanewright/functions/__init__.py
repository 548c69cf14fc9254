"""Column expressions. All of them stay inside whole-stage code generation."""
