"""Loan-tape analytics on Spark."""
