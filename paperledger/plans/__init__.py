"""Whole commands composed from sources and operators."""
