"""Relational, ordered, statistical and graph operators (DataFrame in, DataFrame out)."""
