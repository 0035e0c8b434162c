"""Places of regular-expression matches in whole texts by built-in column functions, in about linear work.

A text is cut into pieces of about ``PIECE`` characters where no match can reach across;
what is done with pairs of matches stays within a piece. Running sums come from blocks of
``BLOCK`` elements, so that no array grows by one element at a time over a whole text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

PIECE, BLOCK = 2000, 128
MATCHES = "array<struct<start:int,end:int,value:string>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def pieces(text: Column, cut: str) -> Column:
    """The text in pieces, whose concatenation it is, that end with a match of ``cut`` or with the text."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}+(?:\z|.*?(?:{cut}|\z))"), F.lit(0))


def sums_before(values: Column) -> Column:
    """For each element of an array of integers, the sum of those before it."""
    nothing = F.array().cast("array<int>")

    def block(own: Column) -> Column:
        step = lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        return F.aggregate(own, F.struct(F.lit(0).alias("at"), nothing.alias("out")), step)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda b: block(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))
    shifted = let(blocks, lambda all_: F.zip_with(all_, block(F.transform(all_, lambda b: b["at"]))["out"], lambda b, o: F.transform(b["out"], lambda x: x + o)))
    return F.when(F.size(values) > BLOCK, F.flatten(shifted)).when(F.size(values) > 0, block(values)["out"]).otherwise(nothing)


def matches(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Array of (start, end, value) of all matches in code points: their texts, and the gaps that a split leaves, give the places."""

    def placed(whole: Column) -> Column:
        value = whole if value_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
        sizes = F.zip_with(whole, F.slice(F.split(text, pattern, -1), 1, F.size(whole)), lambda w, g: F.struct(F.length(g).alias("gap"), F.length(w).alias("size")))
        return let(sizes, lambda s: F.zip_with(
            F.zip_with(s, sums_before(F.transform(s, lambda x: x["gap"] + x["size"])), lambda x, b: F.struct((b + x["gap"]).alias("start"), (b + x["gap"] + x["size"]).alias("end"))),
            value, lambda p, v: F.struct(p["start"].alias("start"), p["end"].alias("end"), v.alias("value"))))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda whole: F.when(F.size(whole) > 0, placed(whole)).otherwise(F.array().cast(MATCHES)))
