"""Generic DataFrame operators: dedup, first per group, interval join, checks, extraction."""
