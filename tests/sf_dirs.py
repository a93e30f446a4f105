"""Folders of the given tables (a module of its own: two conftest.py exist)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
