"""Column helpers shared by the operators; all stay inside Spark expressions."""
