"""Reading and writing the lake."""
