"""Column expressions: no jobs, no state, all inside the JVM."""
