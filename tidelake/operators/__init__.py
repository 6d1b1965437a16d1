"""Write strategies: append, total replace and keyed merge."""
