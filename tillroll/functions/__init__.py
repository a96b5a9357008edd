"""Scalar column expressions: calendar attributes, cleansing rules, safe math."""
