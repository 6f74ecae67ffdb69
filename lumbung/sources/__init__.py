"""Readers, the adapter from TPC-H-like tables, and writers."""
