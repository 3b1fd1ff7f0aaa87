"""Values inside JSON texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nested(document: Column, path: str, kind: str = "string", default=None) -> Column:
    """The value at a dotted ``path`` of a JSON object; ``default`` only where the last key is absent, so that a null stays null.

    A text that is no JSON, and a value that cannot be read as ``kind``, are null."""
    parsed = F.try_parse_json(document)
    parts = path.split(".")
    at = F.try_variant_get(parsed, "$." + ".".join(parts), kind)
    if default is None:
        return at
    holder = F.try_variant_get(parsed, "$" + "".join(f".{p}" for p in parts[:-1]), "map<string,variant>")
    return F.when(holder.isNotNull() & ~F.map_contains_key(holder, F.lit(parts[-1])), F.lit(default).cast(kind)).otherwise(at)
