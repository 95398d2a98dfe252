"""Bindings of the operators to the star-schema test tables.

``views`` derives surveillance-shaped tables from them, ``queries`` runs one
operator or pipeline per key on those views, ``oracles`` holds the SQL twins.
"""
