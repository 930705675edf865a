"""Operators for building training corpora.

Self-contained: nothing outside this folder imports it.  Each module holds
one operator with its own general interface; ``queries`` registers one
``opN_<name>`` query per operator and its DuckDB SQL where SQL can state it.
"""
