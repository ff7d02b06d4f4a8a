"""Distributed building blocks: shared scratch tables, global ranks, exact quantiles, skew-safe lookups."""
