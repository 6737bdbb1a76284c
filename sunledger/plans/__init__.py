"""Compositions: warehouse build, test-table bindings and the query registry."""
