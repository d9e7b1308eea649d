"""JSON scalar access that follows SQL ``JSON_VALUE`` rules.

``get_json_object`` already gives NULL for a missing key, broken text and JSON
null, but it returns the JSON text of an object or array.  ``JSON_VALUE``
returns only scalars, so object and array values become NULL here.  Of a repeated
key the first value that is not null counts, whatever stands elsewhere in the
document.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_path(*keys: str, separator: str | None = None) -> str:
    """Build a ``$['a']['b']`` path from keys, so that a dot in a name is part of
    it; ``separator`` splits a single key (ingest specs use ``a/b`` for nested
    fields).  A name with a quote is written as ``.name``; the path syntax has no
    form for one that holds a dot or a bracket too."""
    parts: list[str] = []
    for k in keys:
        parts.extend(k.split(separator) if separator else [k])
    for p in parts:
        if "'" in p and ("." in p or "[" in p):
            raise ValueError(f"no JSON path for the key {p!r}")
    return "$" + "".join(f".{p}" if "'" in p else f"['{p}']" for p in parts)


def json_value(doc: str | Column, path: str) -> Column:
    """Scalar at ``path`` as text, NULL for missing / null / object / array / bad JSON.

    Text that begins with ``{`` or ``[`` is a container or a string.  Which of them is
    asked of the document put into an array: a wildcard's matches keep their quotes.
    CASE evaluates lazily, so other scalars cost one ``get_json_object`` call.
    """
    d = _as_col(doc)
    text = F.get_json_object(d, path)
    looks_nested = text.startswith("{") | text.startswith("[")
    as_written = F.get_json_object(F.concat(F.lit("["), d, F.lit("]")), f"$[*]{path[1:]}")
    return F.when(looks_nested & ~as_written.startswith('"'), F.lit(None).cast("string")).otherwise(text)


def json_key(doc: str | Column, key: str, separator: str = "/") -> Column:
    """``json_value`` for an ingest-spec key such as ``ytelseType`` or ``a/b``."""
    return json_value(doc, json_path(key, separator=separator))


__all__ = ["json_value", "json_key", "json_path"]
