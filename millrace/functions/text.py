"""Column expressions for text: all run inside the JVM, none is a UDF.

White space is Unicode white space plus the four information separators U+001C to U+001F.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"(?U)[\s\x1c-\x1f]+"
EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def as_col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    return F.regexp_replace(as_col(x), EDGES, "")


def squeeze(x: Column | str) -> Column:
    """Stripped, each run of white space one blank."""
    return F.regexp_replace(strip(x), SPACE, " ")


def text_key(x: Column | str) -> Column:
    """The key by which texts are compared: squeezed, lower case."""
    return F.lower(squeeze(x))


def blank_to_null(x: Column | str) -> Column:
    """The stripped text, null where nothing is left."""
    t = strip(as_col(x).cast("string"))
    return F.when(t != "", t)


def snake(x: Column | str) -> Column:
    """Stripped, lower case, each run of white space one underscore; null stays null."""
    return F.lower(F.regexp_replace(strip(x), SPACE, "_"))


def model_key(x: Column | str) -> Column:
    """A model's name as key: blank to null, lower case, each blank an underscore; hyphens stay."""
    t = F.replace(F.lower(strip(as_col(x).cast("string"))), F.lit(" "), F.lit("_"))
    return F.when(t != "", t)


def evaluated(df: DataFrame, columns: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """df with further columns, each made once per row, and without those to drop.

    A plain projection is merged into the next one, which then makes a value as often as it names it; one row
    made of an array of one struct is not.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in drop]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
