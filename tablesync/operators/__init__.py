"""Predicates, target writes and reports (P*, K1-K4, K6-K7, A*)."""
