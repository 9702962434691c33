"""Column-in, Column-out functions; all of them stay inside the JVM."""
