"""Link columns: absolute links, query parameters, page numbers."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapwatch.functions.text import is_digits, non_empty

# The five parts of a link as RFC 3986 appendix B splits them; every text matches.
_PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated a single time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _parts(url: Column) -> Column:
    names = ("scheme", "host", "path", "query", "anchor")
    return F.struct(*(F.regexp_extract(url, _PARTS, i + 1).alias(n) for i, n in enumerate(names)))


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(F.substring(path, 2, 1 << 30), "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, seg: F.when(seg == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(seg == ".", done)
        .otherwise(F.array_append(done, seg)),
    )
    ends_open = F.element_at(segments, -1).isin(".", "..")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(ends_open & (F.size(kept) > 0), "/").otherwise(""))


def _joined(base: Column, link: Column) -> Column:
    """The link from the parts of its page and its own parts."""
    root = F.concat(base["scheme"], F.lit("://"), base["host"])
    folder = F.regexp_replace(F.when(base["path"] == "", "/").otherwise(base["path"]), "[^/]*$", "")
    # Empty segments go where a path is made of two.
    below = F.regexp_replace(F.concat(folder, link["path"]), "/{2,}", "/")
    target = F.when(link["path"].startswith("/"), link["path"]).otherwise(below)

    def after(mark: str, part: Column) -> Column:
        return F.when(part != "", F.concat(F.lit(mark), part)).otherwise("")

    query, anchor = after("?", link["query"]), after("#", link["anchor"])
    kept_query = F.when(link["query"] != "", query).otherwise(after("?", base["query"]))
    return F.when(link["path"] == "", F.concat(root, base["path"], kept_query, anchor)).otherwise(
        F.concat(root, _without_dots(target), query, anchor)
    )


def url_join(base: Column, link: Column) -> Column:
    """``link`` made absolute against the page ``base`` (RFC 3986); an empty or missing link gives ``base``."""
    both = F.struct(_parts(base).alias("base"), _parts(link).alias("link"))
    return (
        F.when(F.coalesce(link, F.lit("")) == "", base)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, _PARTS, 1), F.lit(":"), link))
        .otherwise(_once(both, lambda x: _joined(x["base"], x["link"])))
    )


def query_param(url: Column, name: str) -> Column:
    """First value of a query parameter that is not blank, decoded; NULL without one."""
    asked = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    value = non_empty(F.regexp_extract(asked, f"(?:^|&){re.escape(name)}=([^&]+)", 1))
    return F.coalesce(F.try_url_decode(value), value)


def query_param_or(url: Column, name: str, default: str) -> Column:
    return F.coalesce(query_param(url, name), F.lit(default))


def next_page_url(url: Column, name: str = "page") -> Column:
    """The link with ``page=n`` counted up by one, NULL when the page is no whole number."""
    page = query_param(url, name)
    following = (page.try_cast("decimal(38,0)") + 1).cast("string")
    return F.when(
        is_digits(page),
        F.replace(url, F.concat(F.lit(f"{name}="), page), F.concat(F.lit(f"{name}="), following)),
    )


def unless_marked(url: Column, marker: str, otherwise: Column) -> Column:
    """``otherwise`` in place of a link that holds ``marker``."""
    return F.when(F.contains(url, F.lit(marker)), otherwise).otherwise(url)

