"""Hash fractions of a row key: random-looking, yet equal for any partitioning and engine."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPAN = 2**32


def row_hash(key: Column | str, seed: int, purpose: str = "") -> Column:
    """Eight hex digits of md5(``seed[:purpose]:key``): uniform, and ordered as text."""
    c = F.col(key) if isinstance(key, str) else key
    prefix = f"{seed}:{purpose}:" if purpose else f"{seed}:"
    return F.substring(F.md5(F.concat(F.lit(prefix), c.cast("string"))), 1, 8)


def key_or_row(df: DataFrame, key: str) -> Column:
    """The row key as text; a row without a key is known by its values instead, so rows without keys
    are spread like any others and equal ones stay together. Maps have no hash and are left out."""
    values = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    whole = F.concat(F.lit("row:"), F.xxhash64(*values).cast("string"))
    return F.coalesce(F.col(f"`{key}`").cast("string"), whole)


def threshold(fraction: float) -> str | None:
    """Hex text such that ``row_hash < threshold`` holds for that fraction of keys.

    ``None`` stands for 1.0 (every hash is below it)."""
    cut = math.ceil(fraction * _SPAN)
    return None if cut >= _SPAN else f"{max(cut, 0):08x}"


def below(hash_column: Column, fraction: float) -> Column:
    cut = threshold(fraction)
    return F.lit(True) if cut is None else hash_column < F.lit(cut)


def poisson_copies(hash_column: Column, rate: float) -> Column:
    """Poisson(``rate``) draw by inverse distribution function of the row hash."""
    cuts, total, j = [], 0.0, 0
    tail = rate + 12 * math.sqrt(rate) + 20
    while j <= tail:
        total += math.exp(-rate + j * math.log(rate) - math.lgamma(j + 1)) if rate > 0 else 1.0
        cut = threshold(total)
        if cut is None:
            break
        cuts.append(cut)
        j += 1
    if not cuts:
        return F.lit(0)
    if len(cuts) > 64:
        # Long tables: count the passed cuts with one array literal instead of a long expression.
        table = F.array(*[F.lit(c) for c in cuts])
        return F.size(F.filter(table, lambda c: c <= hash_column))
    copies = F.lit(0)
    for cut in cuts:
        copies = copies + (hash_column >= F.lit(cut)).cast("int")
    return copies
