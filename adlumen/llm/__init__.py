"""Training-data operators: ten independent modules plus their queries."""
