"""Whole builds out of the operators, and the registered queries."""
