"""Place-name keys and other text functions, all Catalyst built-ins."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@cache
def _ascii_bases() -> tuple[str, str]:
    """Every non-ASCII character whose canonical decomposition holds one ASCII character, and that
    character: the `translate` arguments that stand in for NFD plus removal of marks."""
    source, target = [], []
    for code in range(128, sys.maxunicode + 1):
        decomposed = unicodedata.normalize("NFD", chr(code))
        base = [ch for ch in decomposed if ord(ch) < 128]
        if len(base) == 1:
            source.append(chr(code))
            target.append(base[0])
    return "".join(source), "".join(target)


def strip_accents(c: Column | str) -> Column:
    """Accented letters become their ASCII base; other characters stay as they are.

    Text of one byte per character has none and skips the lookup.
    """
    source, target = _ascii_bases()
    value = _col(c)
    return F.when(F.octet_length(value) == F.length(value), value).otherwise(F.translate(value, source, target))


def plain_key(c: Column | str) -> Column:
    """Lower-cased ASCII letters and digits of the text, everything else removed."""
    return F.lower(F.regexp_replace(_col(c), "[^A-Za-z0-9]", ""))


def name_key(c: Column | str) -> Column:
    """`plain_key` after accents are stripped: the join key of a place name."""
    return plain_key(strip_accents(c))


def normalize_name(c: Column | str) -> Column:
    """Upper-cased ASCII spelling with dashes, apostrophes and runs of blanks as single spaces."""
    ascii_only = F.regexp_replace(strip_accents(c), r"[^\x00-\x7F]", "")
    return F.upper(F.trim(F.regexp_replace(ascii_only, r"[-'\s\x1c-\x1f]+", " ")))


def first_part(c: Column | str) -> Column:
    """Text before the first comma."""
    return F.substring_index(_col(c), ",", 1)


def list_to_text(c: Column | str) -> Column:
    """JSON text of an array column; a NULL list stays NULL."""
    return F.to_json(_col(c))


def base_name(c: Column | str) -> Column:
    return F.element_at(F.split(_col(c), "/"), -1)


def dated_file_name(c: Column | str) -> Column:
    """`<area>_data_YYYYMMDD-HHMMSS.csv` becomes `<area>_weather_YYYY-MM-DD.csv`."""
    return F.regexp_replace(
        _col(c), r"^([^_]*)_[^_]*_(\d{4})(\d{2})(\d{2})(?:-[^_]*)?(?:_.*)?$", "$1_weather_$2-$3-$4.csv"
    )


def file_date(c: Column | str) -> Column:
    """Date in a `..._YYYYMMDD-HHMMSS.csv` file name, NULL when the name has none."""
    return F.try_to_date(F.nullif(F.regexp_extract(_col(c), r"_(\d{8})-", 1), F.lit("")), "yyyyMMdd")
