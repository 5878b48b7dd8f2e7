"""Whole user operations, and the registered queries with their SQL counterparts."""
