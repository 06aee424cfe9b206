"""Plans composed of operators."""
