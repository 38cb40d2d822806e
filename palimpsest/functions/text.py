"""Text functions of names, links and dates. Column expressions; pandas UDFs only where the JVM has no counterpart."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_TAG = re.compile(r"<[^>]+>")
#: The characters that Unicode and Python count as white space.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def shown(value: Column) -> Column:
    """A value without outer white space; blank is null. Linear in the text, unlike a pattern with an end anchor."""
    return F.nullif(F.btrim(value, F.lit(WHITE)), F.lit(""))


def _each_once(s: pd.Series, f) -> pd.Series:
    """Apply a function to the distinct values of a batch: names and links repeat a lot."""
    known = {v: f(v) for v in s.dropna().unique()}
    return pd.Series([known.get(v) for v in s], index=s.index, dtype=object)


def plain(text: str) -> str:
    """Compatibility decomposition without marks, lower case."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def normal_name(text: str) -> str:
    return " ".join(re.findall("[a-z0-9]+", plain(text).replace("&", " and ")))


@F.pandas_udf(StringType())
def normalize(names: pd.Series) -> pd.Series:
    """The key of a name: no case, marks or punctuation, & read as and. Null stays null, a name of signs is ''."""
    return _each_once(names, normal_name)


@F.pandas_udf(StringType())
def clean(fragments: pd.Series) -> pd.Series:
    """Markup as text: character references, then tags become what they show, white space collapses. Null gives ''."""
    return _each_once(fragments, lambda t: " ".join(_TAG.sub(" ", html.unescape(t)).split())).fillna("")


def slug_of_key(key: Column) -> Column:
    """A normal name as an identifier; nothing becomes ``unknown``."""
    return F.coalesce(F.nullif(F.replace(key, F.lit(" "), F.lit("-")), F.lit("")), F.lit("unknown"))


def bare_key(name: Column) -> Column:
    """Lower case, other than a-z and 0-9 collapsed to single spaces: keeps neither accented letters nor &."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+", " "))


def anchor_slug(url: Column) -> Column:
    """What names an entry in its link: the fragment without outer slashes, else the last part of the path."""
    fragment = F.regexp_replace(F.regexp_replace(url, "^[^#]*#", ""), "^/+|/+$", "")
    last = F.regexp_extract(F.regexp_replace(url, "/+$", ""), "([^/]*)$", 1)
    return F.when(F.coalesce(url, F.lit("")) == "", "").when(F.contains(url, F.lit("#")), fragment).otherwise(last)


def day_text(ts: Column) -> Column:
    """The date of a 14-digit moment as text; a shorter value as it is, and ? for none."""
    t = F.coalesce(ts, F.lit(""))
    iso = F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))
    return F.when(F.length(t) >= 8, iso).when(t == "", "?").otherwise(t)


def present(value: Column) -> Column:
    """A text value, or null where it is the empty text."""
    return F.nullif(value, F.lit(""))


def escaped(text: Column) -> Column:
    """Safe inside markup."""
    out = F.coalesce(text, F.lit(""))
    # The five characters with a meaning in HTML.
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(sign), F.lit(entity))
    return out


def haystack(*columns: str) -> Column:
    """The text that a search looks through."""
    return F.lower(F.concat_ws(" ", *columns))


def url_bucket(url: Column) -> Column:
    """The folder of a page in the raw archive."""
    return F.substring(F.sha1(url), 1, 12)


def repaired_json(text: Column) -> Column:
    """A variant: the text parsed, or parsed without commas before a closing bracket, or null."""
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.regexp_replace(text, r",\s*([}\]])", "$1")))


def own_site(website: Column, anchor: Column, legacy: Column, host: str) -> Column:
    """struct(website, anchor): a link to the list's own ``host`` is an anchor, never a website.

    An explicit website wins over the legacy link, which fills whichever of the two it fits.
    """
    w, a, g = (F.coalesce(c, F.lit("")) for c in (website, anchor, legacy))
    internal = F.contains(w, F.lit(host))
    site = F.when(internal, "").otherwise(w)
    site = F.when((site == "") & ~F.contains(g, F.lit(host)), g).otherwise(site)
    to = F.when((a == "") & internal, w).otherwise(a)
    to = F.when((to == "") & F.contains(g, F.lit(host)), g).otherwise(to)
    return F.struct(site.alias("website"), to.alias("anchor"))


def display_time(t: Column) -> Column:
    """HH:MM on a twelve-hour clock, without :00."""
    h = F.substring(t, 1, 2).cast("int")
    m = F.substring(t, 4, 2)
    h12 = F.when(h % 12 == 0, 12).otherwise(h % 12).cast("string")
    return F.concat(h12, F.when(m == "00", "").otherwise(F.concat(F.lit(":"), m)), F.when(h < 12, "am").otherwise("pm"))


def period_text(start: Column, end: Column, still: Column) -> Column:
    """A period for readers; one that lasts has no end."""
    return F.concat(start, F.lit(" to "), F.when(still, F.lit("now")).otherwise(end))
