"""Column-expression helpers: calendar keys and dimension, exact aggregates."""
