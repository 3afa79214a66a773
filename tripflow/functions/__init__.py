"""Column-level building blocks; every one stays inside JVM code generation."""
