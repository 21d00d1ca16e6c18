"""Text helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell contents read as missing, as the usual CSV readers do.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# ASCII whitespace removed at load time (space, tab, LF, VT, FF, CR).
_WS = " \t\n\x0b\x0c\r"


def strip_ws(col: Column | str) -> Column:
    """Trim leading and trailing whitespace of any kind (not only spaces)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit(_WS))


def null_tokens_to_null(col: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Map cells that hold a null token to NULL; keep everything else verbatim."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def contains_any(upper_text: Column, keywords: Iterable[str]) -> Column:
    """Case-insensitive ``%kw%`` match for any keyword.

    ``upper_text`` must already be upper case; keywords are upper-cased here,
    so a plain ``contains`` equals ``ilike '%kw%'`` and stays in codegen.
    """
    cond = None
    for kw in keywords:
        term = upper_text.contains(kw.upper())
        cond = term if cond is None else (cond | term)
    return cond if cond is not None else F.lit(False)
