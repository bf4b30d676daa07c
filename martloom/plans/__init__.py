"""Operators composed into the policy mart: its contracts, loads and transforms."""
