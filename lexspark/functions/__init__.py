"""Column expressions: all row-level logic runs in the JVM."""
