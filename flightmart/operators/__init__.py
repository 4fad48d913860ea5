"""Relational operators of the warehouse load, as DataFrame -> DataFrame functions."""
