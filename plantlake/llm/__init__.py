"""Training-data operators (language ID, decontamination, dedup, mixing, ...).

Nothing else in the library imports this subpackage; its queries are in
``queries.py`` and their DuckDB SQL in ``oracle.py``.
"""
