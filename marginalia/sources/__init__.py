"""Readers and writers for dumps, line files, pages, graphs and vector tables."""
