"""Domain datasets and jobs composed from the operators."""
