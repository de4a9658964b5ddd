"""Helpers of the tests (not in conftest.py: that name is taken once a subfolder has its own)."""

from __future__ import annotations

import os

SF_SMALL = "/root/testdata/sf0.001"


def write_text(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def types_of(df_or_schema):
    """[(name, type)] ignoring nullability."""
    schema = getattr(df_or_schema, "schema", df_or_schema)
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]
