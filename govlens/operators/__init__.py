"""Relational operators: each is a pure function over DataFrames."""
