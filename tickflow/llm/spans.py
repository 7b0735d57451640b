"""Matches of a regular expression with their places, as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MATCH = "struct<start:int,stop:int,match:string,before:string,after:string>"
MATCHES = f"array<{MATCH}>"
STRETCH = 256  # items whose results are appended one by one


def fold(items: Column, state: dict[str, Column], step: Callable[[Column, Column], Column], result: str) -> Column:
    """Array of the results that ``step`` appends to ``out`` along ``items``, in order.

    ``step`` gets a struct of ``state`` and ``out`` and an item and gives such a
    struct.  Appending copies the array, so ``out`` starts anew every ``STRETCH``
    items, and the arrays are joined at the end: the work is that of the items.
    """

    def kept(held: Column) -> list[Column]:
        return [held[name].alias(name) for name in state]

    def along(every: Column) -> Column:
        def stretch(held: Column, at: Column) -> Column:
            zero = F.struct(*kept(held), F.array().cast(f"array<{result}>").alias("out"))
            done = lambda h: F.struct(*kept(h), F.concat(held["outs"], F.array(h["out"])).alias("outs"))
            return F.aggregate(F.slice(every, at * STRETCH + 1, STRETCH), zero, step, done)

        zero = F.struct(*[c.alias(name) for name, c in state.items()], F.array().cast(f"array<array<{result}>>").alias("outs"))
        stretches = F.sequence(F.lit(0), F.floor(F.size(every) / STRETCH).cast("int"))
        return F.flatten(F.aggregate(stretches, zero, stretch, lambda held: held["outs"]))

    # The one element of an outer array, so that the items are made once.
    return F.transform(F.array(items), along)[0]


def _followed_by(text: Column, pattern: Column, context: int) -> Column:
    """The ``context`` characters after each match, in order: gathered from the text's end."""
    gaps = F.reverse(F.split(text, pattern, F.lit(-1)))
    found = F.reverse(F.regexp_extract_all(text, pattern, F.lit(0)))
    turns = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("g"), m.alias("m")))

    def step(held: Column, t: Column) -> Column:
        after = F.left(F.concat(t["g"], held["next"]), F.lit(context))
        more = F.struct(F.left(F.concat(t["m"], after), F.lit(context)).alias("next"), F.concat(held["out"], F.array(after)).alias("out"))
        return F.when(t["m"].isNull(), held).otherwise(more)

    return F.reverse(fold(turns, {"next": F.lit("")}, step, "string"))


def find_all(text: Column, pattern: Column, context: int = 0) -> Column:
    """Array of (start, stop, match, before, after), in order; characters from 0.

    The texts between the matches give the places, so the work is linear in the
    text; ``before`` and ``after`` are the text's ``context`` characters at the
    match's sides, other matches among them.  The pattern must not match the
    empty string.
    """
    # Each array is an argument of its own, so it is made once a text and not once a match.
    found, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, F.lit(-1))
    turns = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    if context:
        turns = F.zip_with(turns, _followed_by(text, pattern, context), lambda t, h: F.struct(t["g"].alias("g"), t["m"].alias("m"), h.alias("h")))

    def last(*parts: Column) -> Column:
        return F.right(F.concat(*parts), F.lit(context)) if context else F.lit("")

    def step(held: Column, t: Column) -> Column:
        start = held["at"] + F.length(t["g"])
        stop = start + F.length(t["m"])
        one = F.struct(
            start.alias("start"),
            stop.alias("stop"),
            t["m"].alias("match"),
            last(held["last"], t["g"]).alias("before"),
            (t["h"] if context else F.lit("")).alias("after"),
        )
        out = F.concat(held["out"], F.array(one)).cast(MATCHES)
        more = F.struct(stop.alias("at"), last(held["last"], t["g"], t["m"]).alias("last"), out.alias("out"))
        return F.when(t["m"].isNull(), held).otherwise(more)  # after the last match only a gap is left

    folded = fold(turns, {"at": F.lit(0), "last": F.lit("")}, step, MATCH)
    return F.when(F.rlike(text, pattern), folded).otherwise(F.array().cast(MATCHES))
