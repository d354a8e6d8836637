"""Column functions: parsing helpers and business rules."""
