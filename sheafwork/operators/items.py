"""Forms, their ordered item lists, and the header pattern of each item."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The items of each form in their order.
ITEMS_10K = "1 1A 1B 1C 2 3 4 5 6 7 7A 8 9 9A 9B 9C 10 11 12 13 14 15 16 SIGNATURE".split()
ITEMS_8K = (
    "1.01 1.02 1.03 1.04 1.05 2.01 2.02 2.03 2.04 2.05 2.06 3.01 3.02 3.03 4.01 4.02 "
    "5.01 5.02 5.03 5.04 5.05 5.06 5.07 5.08 6.01 6.02 6.03 6.04 6.05 7.01 8.01 9.01 SIGNATURE"
).split()
ITEMS_8K_OLD = "1 2 3 4 5 6 7 8 9 10 11 12 SIGNATURE".split()
ITEMS_10Q = (
    "part_1__1 part_1__2 part_1__3 part_1__4 "
    "part_2__1 part_2__1A part_2__2 part_2__3 part_2__4 part_2__5 part_2__6 SIGNATURE"
).split()
#: current reports dated later than this use the new numbering
NEW_8K_AFTER = "2004-08-23"
ROMAN = dict(zip(
    map(str, range(1, 21)),
    "I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX".split(),
))

LISTS = {("10-K", "all"): ITEMS_10K, ("8-K", "new"): ITEMS_8K, ("8-K", "old"): ITEMS_8K_OLD, ("10-Q", "all"): ITEMS_10Q}


class UnknownForm(ValueError):
    """The form has no item list, or none of the requested items belongs to it."""


def era(form: str, date: str | None) -> str:
    return "all" if form != "8-K" else "new" if (date or "") > NEW_8K_AFTER else "old"


def items_for(form: str, date: str | None) -> list[str]:
    """The form's items in order; ISO dates compare as text, a missing one is early."""
    try:
        return LISTS[form, era(form, date)]
    except KeyError:
        raise UnknownForm(f"no item list for {form}") from None


def requested_items(form: str, date: str | None, wanted: list[str] | None) -> list[str]:
    """The wanted items of the form in the caller's order, repeats kept; all of them if none are named."""
    known = items_for(form, date)
    if not wanted:
        return list(known)
    chosen = [w for w in wanted if w in known]
    if not chosen:
        raise UnknownForm(f"none of the requested items belongs to {form}")
    return chosen


def output_key(item: str) -> str:
    """``item_1A``, ``part_2_item_1A``, ``SIGNATURE``."""
    if item == "SIGNATURE":
        return item
    part, _, number = item.partition("__")
    return f"{part}_item_{number}" if number else f"item_{item}"


@lru_cache(maxsize=256)
def header_core(item: str) -> str:
    """What a header of the item looks like, without line start and what follows."""
    part, _, number = item.rpartition("__")
    if not part and number.startswith("part_"):
        n = number[len("part_") :]
        return rf"PART\s*(?:{ROMAN[n]}|{n})"
    if number == "SIGNATURE":
        return r"SIGNATURE(?:s|\(s\))?"
    return rf"ITEMS?\s*(?:{ROMAN[number]}|{number})" if number in ROMAN else rf"ITEMS?\s*{re.escape(number)}"


def item_dim(spark: SparkSession) -> DataFrame:
    """(form, era, ord, item, part, output_key, header): a fixed table of some eighty rows."""
    rows = [
        (form, period, i, item, item.partition("__")[0] if "__" in item else None, output_key(item), header_core(item))
        for (form, period), items in LISTS.items()
        for i, item in enumerate(items)
    ]
    return spark.createDataFrame(rows, "form string, era string, ord int, item string, part string, output_key string, header string")


def item_table(lists: DataFrame) -> DataFrame:
    """The item table from rows of form_name, era_name, part_name, item_pos, item_id; headers are those of :func:`header_core`."""
    era = F.when(F.col("form_name") != "8-K", "all").when(F.col("era_name") == "new", "new").otherwise("old")
    item = F.when(F.col("part_name").isNull(), F.col("item_id")).otherwise(F.concat("part_name", F.lit("__"), "item_id"))
    return lists.select(F.col("form_name").alias("form"), era.alias("era"), (F.col("item_pos") - 1).cast("int").alias("ord"), item.alias("item"), F.col("part_name").alias("part"))


def era_column(form: Column, date: Column) -> Column:
    """The era of a filing as an expression."""
    return F.when(form != "8-K", "all").when(F.to_date(date) > F.lit(NEW_8K_AFTER).cast("date"), "new").otherwise("old")


def with_items(filings: DataFrame, form: str = "filing_type", date: str = "filing_date", dim: DataFrame | None = None) -> DataFrame:
    """Each filing with every item of its form and era: a join with the item table, broadcast if it is our fixed one."""
    items = (dim if dim is not None else F.broadcast(item_dim(filings.sparkSession))).withColumnsRenamed({"form": "_form", "era": "_era"})
    return filings.join(items, (F.col(form) == F.col("_form")) & (era_column(F.col(form), F.col(date)) == F.col("_era"))).drop("_form", "_era")
