"""Table lists, quoted lists and names from templates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters taken off both ends of a name.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """The text without white space at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def table_list(text: Column) -> Column:
    """``'a| b |'`` to ``['a', 'b', '']``: split at the pipe, trim, keep empty names."""
    return F.transform(F.split(text, "[|]"), strip)


def explode_tables(requests: DataFrame, text: str, name: str = "table_name") -> DataFrame:
    """One row per requested name; the other columns are repeated, ``text`` goes."""
    others = [c for c in requests.columns if c != text]
    return requests.select(*others, F.explode(table_list(F.col(text))).alias(name))


def quoted_list(names: Column) -> Column:
    """``['a', 'b']`` to ``'a','b'``."""
    return F.array_join(F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ",")


def from_template(template: str, **values: Column) -> Column:
    """Fill ``{name}`` places of a template with columns, e.g. a queue or path name."""
    pieces = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            pieces.append(values[piece].cast("string"))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)
