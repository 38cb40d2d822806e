"""Rules at the edge of the engine, where pages are fetched: what to retry, how long to wait, what to skip."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from . import markup

#: Words of a link that promises opening hours, files that are no pages, and paths where hours often are.
PROMISING, NO_PAGES, USUAL_PATHS = ("hour", "location", "visit", "contact", "find us"), (".pdf", ".jpg", ".jpeg", ".png", ".webp"), ("/hours", "/contact")
#: Hosts whose pages hold no opening hours.
SOCIAL = r"(?i)instagram\.com|facebook\.com|twitter\.com|linktr\.ee|tiktok\.com"


def outcome(status: Column, body: Column, least_bytes: int = 512, offline: str = "temporarily offline") -> Column:
    """ok, retry (after a pause), again (without one) or gone.

    Overload, server errors, no answer, an offline notice at the head of the body and a body that is too short are
    worth another try after a pause; other client errors without; forbidden and missing pages never.
    """
    head = F.lower(F.substring(F.coalesce(body, F.lit("")), 1, 4000))
    return (
        F.when(status.isNull() | (status == 429) | (status >= 500), "retry")
        .when(status.isin(403, 404), "gone")
        .when(status >= 400, "again")
        .when(F.contains(head, F.lit(offline)) | (F.length(F.coalesce(body, F.lit(""))) < least_bytes), "retry")
        .otherwise("ok")
    )


def wait_seconds(attempt: Column, retry_after: Column, base: float = 2.0, cap: float = 120.0) -> Column:
    """Seconds before the next try: what the server asks for in digits, else an exponential delay with jitter."""
    asked = F.when(F.trim(retry_after).rlike(r"^\d+$"), F.trim(retry_after).cast("double"))
    return F.coalesce(asked, F.least(F.lit(cap), F.pow(F.lit(base), attempt)) * (F.rand() / 2 + 0.5))


def effective_moment(final_url: Column, asked: Column) -> Column:
    """The moment that the archive really served, from the address it led to."""
    return F.coalesce(F.nullif(F.regexp_extract(final_url, r"/web/(\d{14})", 1), F.lit("")), asked)


def has_own_site(website: Column) -> Column:
    return (F.trim(F.coalesce(website, F.lit(""))) != "") & ~F.coalesce(website, F.lit("")).rlike(SOCIAL)


def first_answer(*answers: Column) -> Column:
    """Of several providers' answers in order the first; none gives the marker of a place that was not found."""
    return F.coalesce(*answers, F.struct(F.lit(0.0).alias("lat"), F.lit(0.0).alias("lng"), F.lit("notfound").alias("source")))


def hours_pages(page: Column, base: Column, most: int = 3) -> Column:
    """Links of a page that promise opening hours, in page order, each once, at most ``most``: a top-k by position."""

    @F.pandas_udf(ArrayType(StringType()))
    def found(pages, bases):  # noqa: ANN001, ANN202 - pandas Series of strings
        return pd.Series([_promising(p, b or "", most) for p, b in zip(pages, bases)])

    return found(page, base)


def _promising(page: str | None, base: str, most: int) -> list[str]:
    root, out = base.rstrip("/"), {}
    for e, inner in markup.elements(markup.read(page), lambda e: e.tag == "a"):
        to = e.attributes.get("href", "")
        if not to.startswith(("http", "/")) or "#" in to or "?" in to or to.lower().endswith(NO_PAGES):
            continue
        if any(w in f"{markup.said(inner)} {to}".lower() for w in PROMISING):
            out[(root + to if to.startswith("/") else to).rstrip("/")] = None
    return [u for u in out if u != root][:most]


def site_pages(home: Column, page: Column) -> Column:
    """The pages of a restaurant's site in the order in which they are asked for opening hours, none for a blank or social site.

    Home first, then the links of the home page that promise hours, then the usual paths.
    """
    root = F.regexp_replace(F.trim(home), "/+$", "")
    usual = F.array(*[F.concat(root, F.lit(p)) for p in USUAL_PATHS])
    return F.when(has_own_site(home), F.array_distinct(F.concat(F.array(root), F.coalesce(hours_pages(page, home), F.array().cast("array<string>")), usual))).otherwise(F.array().cast("array<string>"))


def decoded(body: bytes, encoding: str | None) -> bytes:
    """The content of an answer: unpacked by its content encoding, gzip or deflate with or without a header.

    Other and missing encodings leave it as it is; a broken one raises zlib.error.
    """
    kind = (encoding or "").strip().lower()
    if kind == "gzip":
        return zlib.decompress(body, 16 + zlib.MAX_WBITS)
    if kind == "deflate":
        try:
            return zlib.decompress(body)
        except zlib.error:
            return zlib.decompress(body, -zlib.MAX_WBITS)
    return body
