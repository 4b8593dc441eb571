"""Column functions: every one takes and returns a `Column`, all of them JVM-side."""
