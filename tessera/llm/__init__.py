"""Operators of a training-data pipeline. Nothing outside this subpackage imports it,
except the registry at the repository's top, which works without it."""
