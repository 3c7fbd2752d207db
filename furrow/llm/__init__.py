"""Operators for preparing training text at scale, and the queries that apply them.

Nothing outside this subpackage imports it: the rest of the library works
when the folder is absent.
"""
