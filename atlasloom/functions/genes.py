"""Gene families by symbol."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Symbol patterns of the three families, tested on the upper-cased symbol.
FAMILY_PATTERNS = {
    "mt": r"^MT-",
    "ribo": r"^RP[SL]",
    "hb": r"^HB[^P]",
}


def family_flags(symbol: Column | str, patterns: dict[str, str] | None = None) -> dict[str, Column]:
    symbol = F.upper(F.col(symbol) if isinstance(symbol, str) else symbol)
    return {
        name: F.coalesce(symbol.rlike(pattern), F.lit(False))
        for name, pattern in (FAMILY_PATTERNS if patterns is None else patterns).items()
    }
