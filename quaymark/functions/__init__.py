"""Column expressions built only from JVM-side functions."""
