"""Composite plans (Q1-Q12) and the driver-table query registry."""
