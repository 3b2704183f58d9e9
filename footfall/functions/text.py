"""Text functions: splitting, query strings, ``k=v|k=v`` summaries, URL coding."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions._cols import col

NOT_BLANK = r"[^\p{javaWhitespace}]"

# A request with one query part; further question marks are allowed only at its end.
QUERY_PART = r"^[^?]*[?]([^?]+)[?]*$"
# A part of the query with a name and one value, neither of them blank; equals signs may follow.
# What stands behind a repetition is never one of its characters, so the time is linear.
BLANK = r"\p{javaWhitespace}"
PARAMETER = rf"(?:^|&)(?={BLANK}*[^=&{BLANK}])([^=&]*)=(?={BLANK}*[^=&{BLANK}])([^=&]*)=*(?![^&])"
# Characters a browser leaves alone when it encodes a component, but which
# form encoding escapes.
BROWSER_UNESCAPED = (
    ("+", "%20"),
    ("%21", "!"),
    ("%27", "'"),
    ("%28", "("),
    ("%29", ")"),
    ("%7E", "~"),
)


def is_not_blank(c: Column | str) -> Column:
    """Neither null nor white space only."""
    return F.coalesce(col(c).rlike(NOT_BLANK), F.lit(False))


def java_split(c: Column | str, separator: str) -> Column:
    """Split on one character, without the empty parts at the end."""
    text, end = col(c), F.lit(separator)
    # Trimming looks at the whole text, and few texts need it.
    trimmed = F.when(F.endswith(text, end), F.rtrim(text, end)).otherwise(text)
    return F.split(trimmed, "\\" + separator)


def _as_browser(encoded: Column) -> Column:
    for old, new in BROWSER_UNESCAPED:
        encoded = F.replace(encoded, F.lit(old), F.lit(new))
    return encoded


def url_encode(c: Column | str) -> Column:
    """Encode as a browser does for one part of a URL."""
    return _as_browser(F.url_encode(col(c)))


def url_decode(c: Column | str) -> Column:
    """Decode; a plus sign is a space, a broken escape gives null."""
    return F.try_url_decode(col(c))


def _decoded(names: Column, values: Column) -> Column:
    pairs = F.zip_with(
        names,
        values,
        lambda n, v: F.struct(
            F.try_url_decode(n).alias("key"), F.try_url_decode(v).alias("value")
        ),
    )
    return F.map_from_entries(
        F.filter(pairs, lambda p: p["key"].isNotNull() & p["value"].isNotNull())
    )


def parse_query_string(request: Column | str) -> Column:
    """The parameters of a request as a map; a repeated name keeps its last value.

    Parameters without a name or value, or with more than one value, are left out, and so
    are those whose escapes are broken. Only a query with escapes is decoded.
    """
    query = F.regexp_extract(F.coalesce(col(request), F.lit("")), QUERY_PART, 1)
    names, values = [F.regexp_extract_all(query, F.lit(PARAMETER), F.lit(i)) for i in (1, 2)]
    escaped = F.contains(query, F.lit("%")) | F.contains(query, F.lit("+"))
    return F.when(escaped, _decoded(names, values)).otherwise(F.map_from_arrays(names, values))


def build_query_string(params: Column | str) -> Column:
    """``k=v&k=v`` from a map, without entries whose name or value is empty."""
    # Joining leaves out what is null.
    pairs = F.transform(
        F.map_entries(col(params)),
        lambda e: F.when(
            (e["key"] != "") & (e["value"] != ""),
            F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(e["value"])),
        ),
    )
    # The separators contain nothing that is replaced, so one pass over the whole will do.
    return _as_browser(F.array_join(pairs, "&"))


def get_field(summary: Column | str, name: str) -> Column:
    """The value of the first field of this name in ``k=v|k=v``; null where it is missing."""
    pattern = rf"(?:^|[|]){re.escape(name)}=([^=|]*)"
    return F.nullif(F.regexp_extract(col(summary), pattern, 1), F.lit(""))


def set_field(summary: Column | str, name: str, value: Column | str | int) -> Column:
    """Replace the value of the first field of this name; without one, nothing changes."""
    new = value if isinstance(value, Column) else F.lit(str(value))
    fields = java_split(summary, "|")
    names = F.transform(fields, lambda f: F.split_part(f, F.lit("="), F.lit(1)))
    place = F.array_position(names, F.lit(name))
    return F.array_join(
        F.transform(
            fields,
            lambda f, i: F.when(
                i == place - 1, F.concat(F.lit(name + "="), new.cast("string"))
            ).otherwise(f),
        ),
        "|",
    )


def platform_from_user_agent(user_agent: Column | str) -> Column:
    """android, ios or pc. A mark within the first two characters does not count."""
    agent = F.lower(col(user_agent))
    return (
        F.when(F.instr(agent, "android") > 2, "android")
        .when(F.instr(agent, "iphone") > 2, "ios")
        .otherwise("pc")
    )

