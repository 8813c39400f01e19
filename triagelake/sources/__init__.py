"""Readers and writers for claims, splits, fitted parameters and reports."""
