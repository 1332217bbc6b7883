"""Column expressions: everything here returns a ``Column`` and runs in the JVM."""
