"""Column functions: text helpers, entity tagging and vector checks."""
