"""Column functions: masking, value cleaning and calendar days."""
