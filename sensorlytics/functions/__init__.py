"""Column expressions (all JVM-side, codegen-friendly; no Python UDFs)."""
