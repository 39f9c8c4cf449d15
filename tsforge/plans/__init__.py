"""Declared work: quality rules, runs over periods, level-1 tables."""
