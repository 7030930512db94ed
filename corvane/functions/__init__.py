"""Column functions: text, similarity, hashing, statistics."""
