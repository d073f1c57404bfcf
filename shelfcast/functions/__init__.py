"""Column-expression helpers. Everything here compiles to built-in Spark
expressions (whole-stage codegen); no Python runs per row."""
