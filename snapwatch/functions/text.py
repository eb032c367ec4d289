"""Text clean-up: white space, digits, lists, fallbacks and small formats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# All white space including the no-break space, plus the four ASCII separators.
_BLANK = r"[\s\x1c-\x1f]"


def first_digits(text: Column) -> Column:
    """The first run of ASCII digits, NULL without one."""
    return non_empty(F.regexp_extract(text, "([0-9]+)", 1))


def normalize_space(text: Column) -> Column:
    """Collapse blanks, tabs and line ends to one blank and cut them at both ends (XPath rule: no-break space stays)."""
    return F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def strip(text: Column) -> Column:
    """Cut every kind of Unicode white space at both ends."""
    return F.regexp_replace(text, f"(?U)^{_BLANK}+|{_BLANK}+$", "")


def strip_char(text: Column, char: str) -> Column:
    """Cut all leading and trailing copies of ``char``."""
    return F.trim(text, F.lit(char))


def non_empty(text: Column) -> Column:
    """NULL for the empty string."""
    return F.nullif(text, F.lit(""))


def first_non_empty(*options: Column) -> Column:
    """The first option that is neither NULL nor empty."""
    return F.coalesce(*(non_empty(o) for o in options))


def first_of(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


def last_of(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def last_n(items: Column, n: int) -> Column:
    """The last ``n`` members, or all of a shorter list."""
    return F.when(F.size(items) <= n, items).otherwise(F.slice(items, -n, n))


def last_token(text: Column, separator: str = " ") -> Column:
    return F.substring_index(text, separator, -1)


def join_list(items: Column, separator: str) -> Column:
    """Join keeping empty members; a NULL member counts as empty, an empty list gives the empty string."""
    return F.array_join(F.transform(items, lambda x: F.coalesce(x, F.lit(""))), separator)


def lines_of(items: Column, skip: int = 0, keep_empty: bool = True) -> Column:
    """Each member normalised and followed by a line end, from member ``skip`` on."""
    parts = F.transform(F.slice(items, skip + 1, F.greatest(F.size(items), F.lit(1))), normalize_space)
    if not keep_empty:
        parts = F.filter(parts, lambda x: x != "")
    return F.array_join(F.transform(parts, lambda x: F.concat(x, F.lit("\n"))), "")


def is_digits(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9]+$"), F.lit(False))


def to_int(text: Column) -> Column:
    """Whole number after trimming, NULL when the text is not one."""
    return strip(text).try_cast("bigint")


def cut_trailing_slash(text: Column) -> Column:
    return F.regexp_replace(text, "/$", "")


def between_markers(text: Column, opening: str, closing: str) -> Column:
    """What follows the last ``opening`` up to the next ``closing`` (all the rest without one)."""
    return F.substring_index(F.substring_index(text, opening, -1), closing, 1)


def bar_fields(text: Column) -> tuple[Column, Column, Column]:
    """Area, category and date of a text with bars; the last two only exist in a text of four parts."""
    parts = F.split(F.coalesce(text, F.lit("")), r"\|")
    four = F.size(parts) == 4
    area = strip(F.get(parts, F.lit(0)))
    category = F.when(four, strip(F.get(parts, F.lit(2)))).otherwise("")
    posted = F.when(four, strip(F.get(parts, F.lit(3)))).otherwise("")
    return area, category, posted


def fill(template: str, value: Column) -> Column:
    """Put ``value`` in place of the one ``{}`` of ``template``; NULL stays NULL."""
    before, after = template.split("{}")
    return F.concat(F.lit(before), value, F.lit(after))


def unique_id(prefix: str, job_id: Column) -> Column:
    return fill(prefix + "_{}", F.coalesce(job_id.cast("string"), F.lit("")))


def site_of_name(name: Column, sites: Mapping[str, str]) -> Column:
    """Site of a name in any letter case, NULL for an unknown one."""
    pairs: Sequence[Column] = [F.lit(x) for pair in sites.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.initcap(F.lower(name)))
