"""Column expressions: every function here stays inside the JVM (no Python per row)."""
