"""Registered queries (operators bound to parameters), their SQL oracles and
plan inspection helpers."""
