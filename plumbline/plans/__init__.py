"""Compositions: bindings of the sample tables, the registered queries, and the batch layers."""
