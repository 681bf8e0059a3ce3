"""Readers and line parsers.

Parsers take a frame with a string column ``value``, so the same code serves
text files and lines built from tables.
"""
