"""Name standardisation."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_name(name: Column | str) -> Column:
    """Upper case, one blank between words, none around; an empty name is NULL."""
    name = F.col(name) if isinstance(name, str) else name
    squeezed = F.trim(F.regexp_replace(name, r"\s+", " "))
    return F.nullif(F.upper(squeezed), F.lit(""))


def mapped_name(name: Column | str, aliases: Mapping[str, str] | None = None) -> Column:
    """Canonical name, then replaced where ``aliases`` (canonical -> wanted) knows it."""
    canonical = canonical_name(name)
    if not aliases:
        return canonical
    pairs = F.create_map(*[F.lit(v) for v in chain.from_iterable(aliases.items())])
    return F.coalesce(F.try_element_at(pairs, canonical), canonical)
