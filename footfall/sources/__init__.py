"""Inputs, stored tables and text files."""
