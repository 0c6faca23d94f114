"""Names for helper columns beside columns of any name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *stems: str) -> list[str]:
    """Names like `stems` that no column of `df` has, whatever the case, and no two of which are equal."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
