"""Operators that turn a crawl into training data. Nothing else in the package imports them."""
