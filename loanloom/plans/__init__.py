"""Fixture inputs and the registered queries of the loan-tape operators."""
