"""Scalar functions: Column in, Column out, no Python on the executors."""
