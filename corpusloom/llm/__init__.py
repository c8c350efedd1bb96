"""Operators for building training corpora; `queries.queries()` lists their queries.

Each module holds one operator with its own general interface and, at its
end, the thin query that derives the registered digest columns from it.
"""
