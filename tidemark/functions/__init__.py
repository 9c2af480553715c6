"""Column expressions used by the operators; all of them run inside the JVM."""
