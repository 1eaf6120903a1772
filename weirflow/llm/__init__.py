"""Operators for preparing training data: mixing, de-duplication, search, quality, toxicity, leaks and licences."""
