"""Reading landing files, reading and writing layer tables."""
