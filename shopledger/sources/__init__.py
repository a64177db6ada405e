"""Where tables come from: landing files, rate feeds, the warehouse, sample data."""
