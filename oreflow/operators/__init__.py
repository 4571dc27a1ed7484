"""Operators that are more than one DataFrame call, each safe under key skew."""
