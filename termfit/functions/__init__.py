"""Column expressions. All of them are built-in JVM functions; there is no Python UDF."""
