"""Column functions: they take and return Spark columns and need no shuffle."""
