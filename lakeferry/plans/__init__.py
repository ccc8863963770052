"""Which tables there are, what is masked in them, and the order of a load."""
