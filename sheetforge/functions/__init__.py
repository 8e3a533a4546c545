"""Column functions: text, identifiers, values and display strings. None of them leaves the JVM."""
