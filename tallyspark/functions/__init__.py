"""Column-level helpers: exact rounding, text cleaning, date parsing, keyed values."""
