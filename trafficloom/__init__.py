"""Unify nested web-analytics event exports with legacy report history, on Spark."""
