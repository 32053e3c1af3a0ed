"""Whole feeds assembled from the operators."""
