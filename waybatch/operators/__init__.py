"""DataFrame operators: sequence and batching, zone lookup, preparation,
quality checks and routing."""
