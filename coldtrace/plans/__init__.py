"""Reports composed of the operators: validation, traffic, runs, verdicts."""
