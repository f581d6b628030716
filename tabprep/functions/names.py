"""Column-name clean-up. Works on names only, so it costs nothing per row."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import DataFrame


def clean_name(raw: str) -> str:
    """Snake-case one header: blanks and symbols become single underscores.

    Accented letters decompose into a letter and a mark, and the mark counts as a symbol: ``crème`` -> ``cre_me``.
    """
    words = re.split(r"\s+", raw.strip())
    decomposed = unicodedata.normalize("NFKD", "_".join(words).lower())
    return re.sub(r"(?:[^\w]|_)+", "_", decomposed).strip("_") or "col"


def unique_names(names: Iterable[str]) -> list[str]:
    """Number repeats ``x, x_1, x_2``; a number already taken by another column is skipped."""
    given = list(names)
    reserved = set(given)
    repeats: dict[str, int] = {}
    out: list[str] = []
    for name in given:
        if name not in repeats:
            repeats[name] = 0
            out.append(name)
            continue
        candidate = name
        while candidate in reserved:
            repeats[name] += 1
            candidate = f"{name}_{repeats[name]}"
        reserved.add(candidate)
        out.append(candidate)
    return out


def clean_names(names: Iterable[str]) -> list[str]:
    return unique_names(clean_name(n) for n in names)


def standardize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))
