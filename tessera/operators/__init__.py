"""DataFrame -> DataFrame operators, one module per family (B-N of the survey)."""
