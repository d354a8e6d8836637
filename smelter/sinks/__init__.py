"""Writers: layer tables and JDBC tables."""
