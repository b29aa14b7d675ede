"""Column functions: text normalisation, keys and similarities."""
