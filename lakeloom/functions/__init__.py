"""Column expressions. All of them are built-in JVM expressions, no Python UDFs."""
