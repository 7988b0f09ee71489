"""Operators: DataFrame (plus spec or fitted state) in, DataFrame out."""
