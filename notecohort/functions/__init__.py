"""Column-expression builders: everything here returns a pyspark Column and runs JVM-side."""
