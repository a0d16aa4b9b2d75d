"""Column functions: no UDFs, everything stays in the JVM."""
