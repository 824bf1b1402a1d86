"""Operators for building language-model training sets from web-scale text.

Nothing outside this subpackage imports it; ``queries.py`` holds its query
registrations.
"""
