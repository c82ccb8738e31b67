"""Column-level building blocks; every function returns a Column and stays in the JVM."""
