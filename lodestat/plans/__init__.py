"""Chains of operators that make up a whole job."""
