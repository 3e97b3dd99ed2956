"""Relational operators: quality control, daily aggregation, temporal checks, identity, fabric, state, releases."""
