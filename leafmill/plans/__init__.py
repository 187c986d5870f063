"""Ready-made chains of operators."""
