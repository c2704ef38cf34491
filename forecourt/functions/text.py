"""Expressions on feed text and codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if(text: Column, tokens: Sequence[str] = ("",)) -> Column:
    """Trimmed text; null where it equals one of the feed's null tokens."""
    cleaned = F.trim(text)
    return F.when(~cleaned.isin(*tokens), cleaned)


def percent_parse(text: Column, precision: int = 12, scale: int = 6) -> Column:
    """``+x.x%`` to a decimal fraction; null when it is not a percentage."""
    number = F.regexp_extract(F.trim(text), r"^([+-]?(?:\d+(?:\.\d+)?|\.\d+))\s*%$", 1)
    return (number.try_cast(f"decimal({precision},{scale})") / F.lit(100)).cast(
        f"decimal({precision},{scale})")


def code_label(code: Column, labels: Mapping) -> Column:
    """Label of a code; null for codes without one."""
    result = F.lit(None).cast("string")
    for value, label in labels.items():
        result = F.when(code == F.lit(value), F.lit(label)).otherwise(result)
    return result


def yes_no(flag: Column, yes: str = "X") -> Column:
    """``Y`` where the flag holds the given mark, else (and for null) ``N``."""
    return F.when(flag == yes, "Y").otherwise("N")


def plain_header_text(name: Column) -> Column:
    """``plain_header`` of a column of names."""
    last = F.element_at(F.split(F.regexp_replace(name, "\ufeff", ""), r"\."), -1)
    return F.lower(F.regexp_replace(F.trim(F.regexp_replace(last, r"\s+", " ")), " ", "_"))


def plain_header(name: str) -> str:
    """Tidy column name: table prefix and line breaks dropped, words joined by ``_``."""
    words = name.replace("﻿", "").split(".")[-1].split()
    return "_".join(words).lower()
