"""Operators on cells, coordinates, expression and regions; each takes and returns DataFrames."""
