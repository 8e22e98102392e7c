"""Split stored response texts into named sections and numbered items.

Each text is handled inside its own row with Spark's string and array functions, so
nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The section headings, those that hold numbered items, and the section
# of a text without headings.
HEADINGS = ("Headline", "Executive Summary", "Key Risks", "Recommended Actions")
LIST_HEADINGS = ("Key Risks", "Recommended Actions")
DEFAULT_HEADING = "Executive Summary"

# Case-insensitive, Unicode classes, and lines that end at a line feed only.
_FLAGS = "(?imdU)"
# Every character that counts as whitespace at either end of a text.
_SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
_NUMBERED = r"(?dU)^\d+\.\s*(.+)$"
# Control characters around a found heading.
_BEFORE, _AFTER = "\x01\x02\x01", "\x02\x01\x02"


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_SPACES))


def _unquoted(trimmed: Column) -> Column:
    quoted = F.lit(False)
    for mark in ('"', "'"):
        quoted = quoted | (trimmed.startswith(mark) & trimmed.endswith(mark))
    inner = F.substring(trimmed, F.lit(2), F.greatest(F.length(trimmed) - 2, F.lit(0)))
    return F.when(quoted, _strip(inner)).otherwise(trimmed)


def _restored(text: Column) -> Column:
    for written, meant in (("\\n", "\n"), ("\\t", "\t"), ("#", "")):
        text = F.replace(text, F.lit(written), F.lit(meant))
    return _strip(text)


def normalised(df: DataFrame, text_col: str, keep: Sequence[str]) -> DataFrame:
    """``whole``: trimmed text without outer quotes and ``#``, escaped breaks restored."""
    trimmed = df.select(*keep, _strip(F.translate(F.coalesce(text_col, F.lit("")), _BEFORE[:2], "")).alias("trimmed"))
    return trimmed.select(*keep, _restored(_unquoted(F.col("trimmed"))).alias("whole"))


def response_sections(
    df: DataFrame,
    id_cols: Sequence[str],
    text_col: str,
    headings: Sequence[str] = HEADINGS,
    list_headings: Sequence[str] = LIST_HEADINGS,
    default_heading: str = DEFAULT_HEADING,
) -> DataFrame:
    """(ids, section, item_no, item).

    Item 0 is the section's whole text, empty when the text lacks the section; items
    1.. are the numbered lines of a list section. A heading stands alone on its line
    before a colon, in any case. If it occurs twice the last one counts, and text
    before the first heading is dropped.
    """
    names = "|".join(re.escape(h) for h in headings)
    pattern = rf"{_FLAGS}^\s*({names})\s*:\s*$"
    whole = F.col("whole")
    marked = F.regexp_replace(whole, pattern, f"{_BEFORE}$1{_AFTER}")
    parts = F.split(marked, _BEFORE)
    entries = F.transform(F.slice(F.col("parts"), 2, F.size("parts")), _entry)
    split_up = (
        normalised(df, text_col, id_cols)
        .select(*id_cols, "whole", parts.alias("parts"))
        .select(*id_cols, "whole", entries.alias("entries"))
        .select(*id_cols, *(_section(h, default_heading).alias(h) for h in headings))
    )
    rows = F.flatten(F.array(*(_rows(h, h in list_headings) for h in headings)))
    return split_up.select(*id_cols, F.inline(rows))


def _entry(part: Column) -> Column:
    return F.struct(
        F.lower(F.substring_index(part, _AFTER, 1)).alias("heading"),
        _strip(F.element_at(F.split(part, _AFTER, 2), 2)).alias("content"),
    )


def _section(heading: str, default_heading: str) -> Column:
    entries = F.col("entries")
    matches = F.filter(entries, lambda e: e["heading"] == heading.lower())
    found = F.coalesce(F.try_element_at(matches, F.lit(-1))["content"], F.lit(""))
    if heading != default_heading:
        return found
    return F.when(F.size(entries) == 0, F.col("whole")).otherwise(found)


def _rows(heading: str, is_list: bool) -> Column:
    def row(number: Column, item: Column) -> Column:
        return F.struct(
            F.lit(heading).alias("section"), number.alias("item_no"), item.alias("item")
        )

    content = F.col(f"`{heading}`")
    rows = F.array(row(F.lit(0), content))
    if not is_list:
        return rows
    items = F.filter(
        F.transform(
            F.split(content, _LINE_BREAK),
            lambda line: _strip(F.regexp_extract(_strip(line), _NUMBERED, 1)),
        ),
        lambda item: item != "",
    )
    return F.concat(rows, F.transform(items, lambda item, at: row(at + 1, item)))
