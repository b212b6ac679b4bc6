"""Column-expression helpers. Everything here is a built-in Spark expression (JVM-side,
whole-stage codegen); nothing runs in Python per row."""
