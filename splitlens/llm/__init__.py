"""Operators for building training corpora: one module per operator.

``common`` holds the helpers they share, ``components`` connected components,
``queries`` the registered ``opN_<name>`` queries with their DuckDB SQL.
Nothing outside this package imports it.
"""
