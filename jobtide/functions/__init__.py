"""Column-level functions: every one takes and returns ``Column`` and stays in the JVM."""
