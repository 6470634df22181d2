"""Column functions; all of them run in the JVM."""
