"""End-to-end jobs (P1-P15), each a composition of operators returning DataFrames."""
