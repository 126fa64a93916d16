"""Layered (bronze / silver / gold) analytics operators on PySpark DataFrames."""
