"""Column helpers, order filters and fixed values shared by the operators."""
