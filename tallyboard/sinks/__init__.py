"""Results out: weekly partitions and published blocks."""
