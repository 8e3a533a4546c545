"""Relational operators, parametric in table and columns; every one returns a lazy DataFrame."""
