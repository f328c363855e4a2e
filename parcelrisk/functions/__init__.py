"""Column-expression builders (pure, JVM-side, codegen friendly)."""
