"""Column builders and skew-safe ordered scans shared by the operators."""
