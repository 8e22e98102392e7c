"""Reading, typing, registering and writing tables."""
