"""Dotted paths into JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def variant_path(path: str | None) -> str:
    """``meta.next`` as the path ``$['meta']['next']``; no path is the root."""
    if not path:
        return "$"
    return "$" + "".join(f"['{part}']" for part in path.split("."))


def dig(document: Column, path: str | None, dtype: str = "variant") -> Column:
    """The value under a dotted path of a variant, null where a step is missing."""
    return F.try_variant_get(document, variant_path(path), dtype)


def json_text_at(body: Column, path: str) -> Column:
    """The value under a dotted path of JSON text, as text."""
    return F.get_json_object(body, variant_path(path))
