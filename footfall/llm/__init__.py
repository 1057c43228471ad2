"""Operators of a training-data pipeline over text and vectors. Nothing outside this folder imports it."""
