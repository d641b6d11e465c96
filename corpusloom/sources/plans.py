"""What to fetch: files of a listing that is pinned to an edition, as a table of path, address, size and group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def glob_pattern(glob: str) -> str:
    """A glob over whole paths as a regular expression: * and ? go past slashes, [!x] leaves out."""
    out, i = [], 0
    while i < len(glob):
        c, i = glob[i], i + 1
        close = glob.find("]", i + 1) if c == "[" else -1
        if c in "*?":
            out.append("[\\s\\S]" + ("*" if c == "*" else ""))
        elif close > 0:
            inner, i = glob[i:close].replace("\\", "\\\\").replace("[", "\\[").replace("&", "\\&"), close + 1
            out.append("[" + ("^" + inner[1:] if inner[0] == "!" else "\\" + inner if inner[0] == "^" else inner) + "]")
        else:
            out.append("\\" + c if c in r"\.^$*+?{}[]|()" else c)
    return "^" + "".join(out) + "$"


def _escaped(path: Column) -> Column:
    """A path as part of an address; slash, comma and brackets stay."""
    plain = F.replace(F.url_encode(path), F.lit("+"), F.lit("%20"))
    for code, sign in (("%2F", "/"), ("%2C", ","), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        plain = F.replace(plain, F.lit(code), F.lit(sign))
    return F.replace(plain, F.lit("*"), F.lit("%2A"))


def titles(listing: DataFrame, files: str, *, only: Sequence[int] = (), edition: str = "latest") -> DataFrame:
    """(group, edition, url) of each title that is not reserved, at its own date unless an edition is named.

    listing: number, reserved, up_to_date_as_of. Null `reserved` counts as false.
    """
    held = listing.where(~F.coalesce(F.col("reserved"), F.lit(False)))
    held = held.where(F.col("number").isin(*only)) if only else held
    date = F.col("up_to_date_as_of").cast("string") if edition == "latest" else F.lit(edition)
    number = F.col("number").cast("string")
    url = F.concat(F.lit(files.rstrip("/") + "/"), date, F.lit("/title-"), number, F.lit(".xml"))
    return held.select(F.concat(F.lit("title-"), number).alias("group"), date.alias("edition"), url.alias("url"))


def tree(listing: DataFrame, files: str, commit: str, globs: Sequence[str], *, truncated: bool = False) -> DataFrame:
    """(path, url, size, group) of the files of one commit that a glob names.

    listing: path, type, size. A truncated listing is refused, and so is a path that leaves the root.
    """
    if truncated:
        raise ValueError(f"the tree at {commit} is truncated; list it by directory")
    path = F.col("path")
    wanted = F.lit(False)
    for glob in globs:
        wanted = wanted | path.rlike(glob_pattern(glob))
    leaves = path.startswith("/") | path.rlike(r"(?:^|/)\.\.(?:/|$)")
    checked = F.when(leaves, F.raise_error(F.concat(F.lit("a listed file leaves the root: "), path)).cast("string")).otherwise(path)
    rows = listing.where((F.col("type") == "blob") & wanted).select(checked.alias("p"), F.col("size").cast("long").alias("size"))
    full = F.concat(F.lit(commit + "/"), "p")
    return rows.select(full.alias("path"), F.concat(F.lit(files.rstrip("/") + "/"), _escaped(full)).alias("url"), "size", F.regexp_replace("p", "/?[^/]*$", "").alias("group"))
