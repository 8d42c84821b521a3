"""Formats of reports and settings as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration(seconds: Column) -> Column:
    """``12.3s`` below a minute, else ``2m 05s``."""
    whole = F.floor(seconds).cast("long")
    long = F.format_string("%dm %02ds", F.floor(whole / 60).cast("long"), whole % 60)
    return F.when(seconds < 60, F.format_string("%.1fs", seconds.cast("double"))).otherwise(long)


def french_time(time: Column) -> Column:
    """A time as French readers write it; empty for null."""
    return F.coalesce(F.date_format(time, "dd/MM/yyyy HH:mm:ss"), F.lit(""))


def settings(least: Column, most: Column, timeout: Column) -> Column:
    """struct<min_delay, max_delay, timeout_ms>: defaults for nulls, no delay below 0 or its minimum, a second's timeout at least."""
    low = F.greatest(F.lit(0), F.coalesce(least, F.lit(1200)))
    high = F.greatest(low, F.coalesce(most, F.lit(2600)))
    return F.struct(low.alias("min_delay"), high.alias("max_delay"), F.greatest(F.lit(1000), F.coalesce(timeout, F.lit(15000))).alias("timeout_ms"))


def delay(low: Column, high: Column, seed: int) -> Column:
    """A whole number from low to high, all alike likely."""
    return (F.floor(F.rand(seed) * (high - low + 1)) + low).cast("long")


def literal(text: str) -> str:
    """A pattern that matches the text and nothing else."""
    return re.sub(r"[.*+?^${}()|\[\]\\]", r"\\\g<0>", text)


def page_file(pages: Column, total: Column) -> Column:
    """The texts of a document's pages (a map by number), each below its mark; pages that are missing are empty."""
    one = lambda i: F.concat(F.lit("\n===== PAGE "), i.cast("string"), F.lit(" =====\n"), F.coalesce(F.try_element_at(pages, i), F.lit("")))
    return F.when(total > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(total, F.lit(1))), one), "\n")).otherwise("")
