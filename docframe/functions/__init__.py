"""Column helpers: text analysis, date math, distances, vectors."""
