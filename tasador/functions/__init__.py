"""Column functions: text in, text or number out, all inside the JVM."""
