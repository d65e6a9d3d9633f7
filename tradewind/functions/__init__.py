"""Column-expression helpers; everything here stays inside code generation."""
