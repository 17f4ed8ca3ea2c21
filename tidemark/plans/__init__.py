"""Whole results composed of the operators."""
