"""Keyed and stateful operators (DataFrame -> DataFrame)."""
