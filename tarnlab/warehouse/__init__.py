"""Versioned tables, mutations with a change log, and commits of reconciled events."""
