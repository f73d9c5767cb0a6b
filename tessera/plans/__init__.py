"""Derived inputs, the query registry and end-to-end flows."""
