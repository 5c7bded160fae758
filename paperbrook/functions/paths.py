"""Columns read from a file's path: root, levels, category, year, month."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names, their three-letter forms, and one four-letter form.
MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
EXTRA_MONTH_NAMES = {"sept": 9}


def month_numbers() -> dict[str, int]:
    named = {name: i for i, name in enumerate(MONTHS, start=1)}
    short = {name[:3]: i for name, i in named.items()}
    return {**named, **short, **EXTRA_MONTH_NAMES}


def month_number(name: Column) -> Column:
    """Month name in any case to 1..12; unknown or null gives null."""
    pairs = [F.lit(x) for item in month_numbers().items() for x in item]
    return F.element_at(F.create_map(*pairs), F.lower(name))


def strip_root(path: Column, root: str) -> Column:
    """Path below ``root``, taken literally; a path outside it is kept whole."""
    return F.when(path.startswith(root), F.substr(path, F.lit(len(root) + 1))).otherwise(path)


def path_levels(rel_path: Column) -> Column:
    return F.split(rel_path, "/")


def normalise_uri(path: Column, decode: bool = False) -> Column:
    """Drop the scheme, leaving one leading slash; ``decode`` also resolves %XX and leaves ``+`` alone."""
    local = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:/+", "/")
    if not decode:
        return local
    return F.coalesce(F.try_url_decode(F.replace(local, F.lit("+"), F.lit("%2B"))), local)


def path_metadata(files: DataFrame, root: str) -> DataFrame:
    """Add rel_path, levels, category, year and month; a shallow or odd path gives nulls."""
    return (
        files.withColumn("rel_path", strip_root(F.col("path"), root))
        .withColumn("levels", path_levels(F.col("rel_path")))
        .withColumns({
            "category": F.get("levels", F.lit(0)),
            "year": F.get("levels", F.lit(1)).try_cast("int"),
            "month": month_number(F.get("levels", F.lit(2))),
        })
    )


def glob_regex(glob: str) -> str:
    """A listing glob as a pattern for file names: ``*``, ``?``, ``[...]`` and ``{a,b}``; all else is literal."""
    out, at, depth = "", 0, 0
    while at < len(glob):
        sign = glob[at]
        end = glob.find("]", at + 2) if sign == "[" else -1
        if sign == "*":
            out += "[^/]*"
        elif sign == "?":
            out += "[^/]"
        elif end > 0:
            inside = glob[at + 1 : end]
            negated = inside[0] in "!^"
            inside = inside[1:] if negated else inside
            out += ("[^" if negated else "[") + re.sub(r"([\\\[\]^&])", r"\\\1", inside) + "]"
            at = end
        elif sign == "{":
            out, depth = out + "(?:", depth + 1
        elif sign == "}" and depth:
            out, depth = out + ")", depth - 1
        elif sign == "," and depth:
            out += "|"
        else:
            if sign == "\\" and at + 1 < len(glob):
                at += 1
            out += re.escape(glob[at])
        at += 1
    if depth:
        raise ValueError(f"a brace is not closed: {glob}")
    return out


def glob_match(path: Column, glob: str) -> Column:
    """File name matches the glob: the listing glob for rows already read."""
    return path.rlike(f"(^|/){glob_regex(glob)}$")
