"""Column functions; all of them stay inside the JVM unless their name says otherwise."""
