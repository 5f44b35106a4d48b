"""Whole experiments, and the catalogue of runnable queries."""
