"""Reading case tables, writing results, saving and loading models."""
