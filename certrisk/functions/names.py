"""Distinguished names as maps, with the ordering rules of a Python dict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certrisk.functions.text import strip

ENTRIES = "array<struct<key:string,value:string>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    Inside a lambda nothing is shared between uses, so an expression used twice
    there is bound to a lambda variable first.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns`` added or replaced, each computed once per row however often it is read.

    Catalyst writes the expression of a column that feeds a Python function into every place that reads it, those within that
    expression included, so that a chain of such columns grows to many times its length. It does not do so across a generator.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _outside_quotes(pieces: Column) -> Column:
    """The pieces between quotes joined again, separating commas as line breaks."""
    return F.array_join(F.transform(
        pieces,
        lambda piece, i: F.when(
            (F.size(pieces) - 1 - i) % 2 == 0, F.regexp_replace(piece, r",\s*", "\n"))
        .otherwise(piece)), '"')


def dn_entries(dn: Column) -> Column:
    """``key=value`` pairs of a one-line name.

    A comma separates two parts when an even number of double quotes follows it.
    The line is cut at the quotes, commas are turned into line breaks in the
    pieces where they separate, and the pieces are joined again: linear time
    and no look-ahead, however long the line is.
    """
    parts = F.split(let(F.split(dn, '"'), _outside_quotes), "\n")
    kept = F.filter(parts, lambda p: F.contains(p, F.lit("=")))
    return F.coalesce(
        F.transform(kept, lambda p: F.struct(
            strip(F.substring_index(p, "=", 1)).alias("key"),
            strip(F.substr(p, F.instr(p, "=") + 1)).alias("value"))),
        F.array().cast(ENTRIES))


def entries_to_map(entries: Column) -> Column:
    """Map of the entries; a repeated key keeps its place and takes the last value."""
    def last_values(all_entries: Column) -> Column:
        names = F.transform(all_entries, lambda e: e["key"])
        kept = F.transform(F.array_distinct(names), lambda name: F.struct(
            name.alias("key"),
            F.element_at(F.filter(all_entries, lambda e: e["key"] == name), -1)["value"]
            .alias("value")))
        return F.map_from_entries(kept)

    return let(entries, last_values)


def parse_dn(dn: Column) -> Column:
    return entries_to_map(dn_entries(dn))


def sorted_entries(m: Column) -> Column:
    """Maps cannot be compared; their sorted entries can."""
    return F.array_sort(F.map_entries(m))


def map_key(m: Column) -> Column:
    return F.to_json(sorted_entries(m))
