"""Arrival messages: parsing, classification, and loading on arrival."""
