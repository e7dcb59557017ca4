"""Pages far behind the start of an ordered result, by a directory of files.

A store keeps, per scope, fact file and year, the rows and the first and last
area (``FactStore.file_directory``).  Rows are ordered by area first, so for any
area name b

* the rows before b are *at most* those of all entries that begin before b,
* and *at least* those of all entries that end before b.

The page therefore starts at or behind the last b of which at most ``offset``
rows come before, and ends before the first b of which at least ``offset +
limit`` rows do.  Only files that overlap this range of areas are read: per year
and category one or two, wherever the page is.  How many rows come before the
range is a sum over the entries, plus a count in the files that its start cuts.

The directory's entries of one indicator and area type reach the driver: one
per file and year.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.operators import query as q


def area_range(entries: list, offset: int, limit: int) -> tuple[str | None, str | None]:
    """(first area, area behind the last) of a range that holds the page; None: unbounded."""
    marks = sorted({e["first_area"] for e in entries})
    begins = sorted((e["first_area"], e["rows"]) for e in entries)
    ends = sorted((e["last_area"], e["rows"]) for e in entries)

    def running(pairs):
        names, total = [], [0]
        for name, rows in pairs:
            names.append(name)
            total.append(total[-1] + rows)
        return lambda b: total[bisect_left(names, b)]    # rows of entries whose name is below b

    at_most, at_least = running(begins), running(ends)
    low = max((b for b in marks if at_most(b) <= offset), default=None)
    high = min((b for b in marks if at_least(b) >= offset + limit), default=None)
    return low, high


def covering(store, directory: DataFrame, indicator: str, area_type: str, categories, year_from, year_to, limit: int,
             offset: int) -> tuple[DataFrame, int]:
    """(facts, skipped): the facts of a page's area range, from the files that
    overlap it, and how many rows of the result come before it."""
    q._check_page(limit, offset)
    entries = q.timeseries_filter(directory, indicator, area_type, None, categories, year_from, year_to).select(
        "file", "first_area", "last_area", "rows").collect()
    low, high = area_range(entries, offset, limit)
    skipped = 0
    if low is not None:
        skipped = sum(e["rows"] for e in entries if e["last_area"] < low)
        cut = [e for e in entries if e["first_area"] < low <= e["last_area"]]
        if cut:
            # an entry's file also holds other years: those entries that lie before are in the sum already
            inside = q.timeseries_filter(store.of_files(cut), indicator, area_type, None, categories, year_from, year_to)
            before = inside.where(F.col("area_name") < F.lit(low)).count()
            whole = {e["file"] for e in cut}
            skipped += before - sum(e["rows"] for e in entries if e["last_area"] < low and e["file"] in whole)
    wanted = [e for e in entries if (low is None or e["last_area"] >= low) and (high is None or e["first_area"] < high)]
    facts = store.of_files(wanted)
    if low is not None:
        facts = facts.where(F.col("area_name") >= F.lit(low))
    if high is not None:
        facts = facts.where(F.col("area_name") < F.lit(high))
    return facts, skipped
