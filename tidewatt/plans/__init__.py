"""Jobs, models, metrics and charts composed from the operators."""
