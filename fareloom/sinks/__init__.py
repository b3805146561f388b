"""Writers, publishing and versioned tables."""
