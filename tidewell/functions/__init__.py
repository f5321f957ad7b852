"""Column functions. All are null-safe under ANSI mode and stay on the JVM."""
