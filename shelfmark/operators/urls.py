"""URLs of projects taken apart, a table at a time.

Intermediate texts are columns of their own: each is used several times, and a
column that costs something is computed once only if it stands in a step before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import strip
from shelfmark.functions.urls import (
    HOST,
    PREFIX,
    after,
    before,
    is_project_url,
    percent_decoded,
    readme_slug,
    sanitized,
    without_suffix,
)

KEY = "project_url"


def with_url_validity(df: DataFrame, url: str = KEY) -> DataFrame:
    return df.withColumn("valid", is_project_url(F.col(url)))


def sanitize_urls(df: DataFrame, url: str = KEY) -> DataFrame:
    return df.withColumn("sanitized_url", sanitized(F.col(url)))


def parse_repo_url(df: DataFrame, url: str = KEY) -> DataFrame:
    """Add owner, repo, subpath, branch; all null when owner and repo are not both there.

    White space, query, fragment and closing slashes go first. What follows
    '/tree/' is branch and subpath, what follows '/blob/' branch only; both are
    percent-decoded. Text without the host counts as 'owner/repo'.
    """
    cut = F.rtrim(before(before(strip(F.col(url)), "?"), "#"), F.lit("/"))
    marks = df.withColumn("_u", cut).withColumns(
        {"_tree": after(F.col("_u"), "/tree/"), "_blob": after(F.col("_u"), "/blob/")}
    )
    base = F.when(F.col("_tree").isNotNull(), before(F.col("_u"), "/tree/")).otherwise(
        before(F.col("_u"), "/blob/")
    )
    named = F.split(F.replace(without_suffix(base, ".git"), F.lit(PREFIX), F.lit("")), "/")
    parts = marks.withColumn("_p", named)
    ok = (F.get("_p", F.lit(0)) != "") & (F.get("_p", F.lit(1)) != "")
    return parts.withColumns(
        {
            "owner": F.when(ok, F.get("_p", F.lit(0))),
            "repo": F.when(ok, F.get("_p", F.lit(1))),
            "subpath": F.when(ok, percent_decoded(after(F.col("_tree"), "/"))),
            "branch": F.when(ok, percent_decoded(before(F.coalesce("_tree", "_blob"), "/"))),
        }
    ).drop("_u", "_tree", "_blob", "_p")


def locate_readmes(df: DataFrame, url: str = KEY) -> DataFrame:
    """Add where the README of each URL is looked for: owner, repo, branch, folder, direct.

    `direct` is true when the URL itself names the README. All are null for
    other hosts, for URLs without a repository, and for a URL that ends right
    after 'tree' or 'blob', which names no branch. A filter on the results is
    pushed below this step with all they are made of, hence plain functions.
    """
    u = before(before(F.col(url), "?"), "#")
    u = F.when(u.contains(";"), F.regexp_replace(u, ";[^/]*$", "")).otherwise(u)
    u = F.replace(u, F.lit("https://GitHub.com/"), F.lit(PREFIX))
    tail = F.when(u.contains(HOST), F.substring_index(u, HOST, -1))
    split = df.withColumn("_p", F.split(tail, "/"))
    tree, blob = F.array_position("_p", "tree"), F.array_position("_p", "blob")
    # Position of the part that stands before the branch, 0 if there is none.
    found = split.withColumn("_at", F.when(tree > 0, tree).otherwise(blob).cast("int"))
    size, at = F.size("_p"), F.col("_at")
    direct = F.array_contains("_p", "README.md")
    usable = (size >= 2) & (direct | (at < size))
    first = F.when(at > 0, at + 2).otherwise(F.lit(3))
    tail_parts = F.slice("_p", first, F.greatest(size - first + 1, F.lit(0)))
    return found.withColumns(
        {
            "owner": F.when(usable, F.get("_p", F.lit(0))),
            "repo": F.when(usable, F.replace(F.get("_p", F.lit(1)), F.lit(".git"), F.lit(""))),
            "branch": F.when(usable & ~direct & (at > 0), F.get("_p", at)),
            "folder": F.when(usable & ~direct, F.array_join(tail_parts, "/")),
            "direct": F.when(usable, direct),
        }
    ).drop("_p", "_at")


def readme_candidates(df: DataFrame, filename: str = "readme_name") -> DataFrame:
    """Add `path` and `fallback_path` to located READMEs whose file name is known.

    The fallback drops the first 'branch/' inside the folder.
    """
    name, folder, direct = F.col(filename), F.col("folder"), F.col("direct")
    prefix = F.concat("branch", F.lit("/"))
    at = F.instr(folder, prefix)
    inner = F.concat(
        F.substring(folder, F.lit(1), at - 1),
        F.substring(folder, at + F.length(prefix), F.length(folder)),
    )
    joined = lambda d: F.when(
        name.isNotNull() & ~direct, F.concat_ws("/", F.nullif(d, F.lit("")), name)
    )
    return df.withColumns(
        {
            "path": F.when(direct, F.lit("README.md")).otherwise(joined(folder)),
            "fallback_path": joined(F.when(at > 0, inner).otherwise(folder)),
        }
    )


def readme_requests(df: DataFrame, url: str = KEY) -> DataFrame:
    """Which README the README-only job asks for: owner, repo, folder.

    A URL with a tree part names a folder; any other one the repository's own
    README, folder null.
    """
    located = locate_readmes(df, url).withColumn("_s", F.split(readme_slug(F.col(url)), "/"))
    in_tree = F.col(url).contains("/tree/")
    return located.withColumns(
        {
            "owner": F.when(in_tree, F.col("owner")).otherwise(F.get("_s", F.lit(0))),
            "repo": F.when(in_tree, F.col("repo")).otherwise(F.get("_s", F.lit(1))),
            "folder": F.when(in_tree, F.col("folder")),
        }
    ).drop("_s", "branch", "direct")
