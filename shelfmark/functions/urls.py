"""Column expressions that take repository and course URLs apart.

No ``parse_url``: it raises on a blank inside a URL, which the rules here accept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOST = "github.com/"
PREFIX = "https://" + HOST


def after(c: Column, mark: str) -> Column:
    """What follows the first occurrence of `mark`; null when there is none."""
    at = F.instr(c, mark)
    return F.when(at > 0, F.substring(c, at + len(mark), F.length(c)))


def before(c: Column, mark: str) -> Column:
    return F.substring_index(c, mark, 1)


def without_suffix(c: Column, suffix: str) -> Column:
    shorter = F.substring(c, F.lit(1), F.length(c) - len(suffix))
    return F.when(c.endswith(suffix), shorter).otherwise(c)


def is_project_url(c: Column) -> Column:
    """https, exactly the expected host, a path beyond '/'; null counts as no."""
    return F.coalesce(c.rlike(r"^(?i:https)://github\.com/[^?#;]"), F.lit(False))


def percent_decoded(c: Column) -> Column:
    """Decode %XX; a plus sign and an incomplete escape stay as they are."""
    escaped = F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))


def sanitized(url: Column) -> Column:
    """scheme://host/path, without parameters, query and fragment."""
    path = before(before(url, "?"), "#")
    path = F.when(path.contains(";"), F.regexp_replace(path, ";[^/]*$", "")).otherwise(path)
    scheme = r"^([A-Za-z][A-Za-z0-9+.\-]*):(?://)?"
    other = F.concat(
        F.lower(F.regexp_extract(path, scheme, 1)),
        F.lit("://"),
        F.regexp_replace(F.regexp_replace(path, scheme, ""), "^//", ""),
    )
    return F.when(path.startswith("https://"), path).otherwise(other)


def readme_slug(url: Column) -> Column:
    """'owner/repo' as the README endpoint takes it, for URLs without a tree part."""
    return F.rtrim(without_suffix(F.substring_index(url, HOST, -1), ".git"), F.lit("/"))


# Fixed value: what a link to a course ends in.
COURSE_SLUG = r"/([a-z][a-z0-9-]+-(\d{4}))/?$"


def course_slug(href: Column) -> Column:
    """struct<slug, year>; null when the link is not a course link."""
    slug = F.regexp_extract(href, COURSE_SLUG, 1)
    year = F.regexp_extract(href, COURSE_SLUG, 2)
    return F.when(slug != "", F.struct(slug.alias("slug"), year.cast("int").alias("year")))
