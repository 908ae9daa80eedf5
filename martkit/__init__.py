"""martkit: Spark operators and mart definitions for business feeds."""
