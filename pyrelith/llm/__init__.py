"""Operators of a training-data pipeline. Nothing outside this subpackage imports it, but the entry file."""
