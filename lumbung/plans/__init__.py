"""Warehouse models: staging, intermediate, dimensions, fact, marts, reports, checks, runs."""
