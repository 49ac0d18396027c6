"""Column-level building blocks (JVM-side expressions only)."""
