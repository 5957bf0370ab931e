"""Reading, typing, checking and writing document tables."""
