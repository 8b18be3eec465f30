"""Queries over the driver tables in the roles of a monitoring warehouse."""
