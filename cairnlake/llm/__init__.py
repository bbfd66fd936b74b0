"""Operators for preparing training text, each by the method its module names."""
