"""Column-level helpers (F1-F18). All built-in Spark expressions: they stay
inside whole-stage codegen; nothing here runs Python per row."""
