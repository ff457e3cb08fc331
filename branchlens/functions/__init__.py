"""Column-level helpers; all of them stay inside JVM expressions."""
