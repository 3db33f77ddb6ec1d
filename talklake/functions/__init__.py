"""Column expressions. Everything here is row-local and stays in the JVM."""
