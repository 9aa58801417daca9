"""Operators of a training-data pipeline. Nothing outside this subpackage
imports it; ``catalog`` holds the registered queries and their SQL."""
