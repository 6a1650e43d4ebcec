"""Operators: row rules, quality counts, joins, anomaly flags."""
