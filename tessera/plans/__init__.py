"""Plans: operators put together over named tables."""
