"""Registered queries over the test tables, their SQL counterparts, and fixtures."""
