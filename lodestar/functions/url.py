"""URL functions as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_url(url: Column) -> Column:
    """Scheme, host and path: without query, fragment, the last segment's parameters and trailing slashes; the scheme in lower case."""
    bare = F.regexp_replace(F.trim(url), r"(?s)[?#].*$", "")
    bare = F.regexp_replace(bare, ";[^/]*$", "")
    bare = F.rtrim(bare, F.lit("/"))
    scheme = F.regexp_extract(bare, "^[A-Za-z][A-Za-z0-9+.-]*:", 0)
    return F.concat(F.lower(scheme), F.substr(bare, F.length(scheme) + 1))


def host(url: Column) -> Column:
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_replace(canonical_url(url), "^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")


def slug(url: Column) -> Column:
    """The last segment of the canonical form."""
    return F.element_at(F.split(canonical_url(url), "/"), -1)


def topic_slug(url: Column) -> Column:
    """The last segment of the path; "root" for an empty path."""
    own = F.btrim(path(url), F.lit("/"))
    return F.coalesce(F.nullif(F.element_at(F.split(own, "/"), -1), F.lit("")), F.lit("root"))


def with_params(url: Column, **params) -> Column:
    """Existing parameters keep their place, a repeated one its last value; given ones are set or appended, None is left out.

    Values are form-encoded, the fragment stays last.
    """
    fragment = F.regexp_extract(url, "(?s)#.*$", 0)
    bare = F.regexp_replace(url, "(?s)#.*$", "")
    query = F.regexp_extract(bare, r"(?s)\?(.*)$", 1)
    base = F.regexp_replace(bare, r"(?s)\?.*$", "")
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            F.try_url_decode(F.split(p, "=", 2)[0]).alias("k"),
            F.coalesce(F.try_url_decode(F.try_element_at(F.split(p, "=", 2), F.lit(2))), F.lit("")).alias("v"),
        ),
    )
    for key, value in params.items():
        if value is not None:
            value = value if isinstance(value, Column) else F.lit(str(value))
            pairs = F.concat(pairs, F.array(F.struct(F.lit(key).alias("k"), value.cast("string").alias("v"))))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    encoded = F.transform(
        keys,
        lambda k: F.concat(F.url_encode(k), F.lit("="), F.url_encode(F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"])),
    )
    return F.concat(base, F.when(F.size(keys) > 0, F.concat(F.lit("?"), F.array_join(encoded, "&"))).otherwise(""), fragment)


def listing_url(url: Column, page: Column) -> Column:
    """The listing page: guide=1, and the page's number from the second on."""
    return F.when(page <= 1, with_params(url, guide=1)).otherwise(with_params(url, guide=1, page=page))


def enforce_listing(url: Column) -> Column:
    """The URL with guide=1, unchanged where it has it."""
    return F.when(url.rlike(r"[?&]guide=1(&|#|$)"), url).otherwise(with_params(url, guide=1))


def absolute_root_relative(base: Column, href: Column) -> Column:
    """A root-relative link against its page's scheme and host; absolute links stay."""
    root = F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    return F.when(href.startswith("//"), F.concat(F.regexp_extract(base, "^[^:]*:", 0), href)).when(href.startswith("/"), F.concat(root, href)).otherwise(href)


def is_topic_link(href: Column, reject: list[str], tokens: list[str]) -> Column:
    """Links with one of ``tokens`` and none of ``reject``."""
    wanted, unwanted = F.lit(False), F.lit(False)
    for t in tokens:
        wanted = wanted | href.contains(t)
    for t in reject:
        unwanted = unwanted | href.contains(t)
    return wanted & ~unwanted


# What marks a challenge page.
CHALLENGE_TOKENS = [
    "captcha",
    "are you a human",
    "verify you are a human",
    "recaptcha",
    "hcaptcha",
    "cf-challenge",
    "data-sitekey",
    "cloudflare ray id",
]
PROVIDERS = ["recaptcha", "hcaptcha", "cf-challenge"]


def is_challenge(html: Column) -> Column:
    """A challenge token together with a form or a provider's name; false for no page."""
    low = F.lower(F.coalesce(html, F.lit("")))
    token, provider = F.lit(False), F.lit(False)
    for t in CHALLENGE_TOKENS:
        token = token | low.contains(t)
    for p in PROVIDERS:
        provider = provider | low.contains(p)
    return token & (provider | low.rlike("<form[^>]*>"))


def is_thin(title: Column, text: Column, least: int = 80) -> Column:
    """Pages to be rendered again: no title, no text, or less than ``least`` characters."""
    return F.coalesce(title, F.lit("")).eqNullSafe("") | (F.length(F.coalesce(text, F.lit(""))) < least)
