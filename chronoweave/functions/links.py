"""Links of an HTML page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text that holds no tags, an anchor's start tag with its quoted href,
# the origin of an address, and the named characters that addresses contain.
NO_TAGS = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
ANCHOR = r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
ENTITIES = {"&quot;": '"', "&#39;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def resolve(base: Column, href: Column) -> Column:
    """An href against the address of its page (no dot-segment removal)."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, ORIGIN, 1)
    clean = F.regexp_replace(base, r"[?#].*$", "")
    no_fragment = F.regexp_replace(base, r"#.*$", "")
    below = F.regexp_replace(F.regexp_replace(clean, ORIGIN, ""), r"[^/]*$", "")
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(clean, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href == "", no_fragment)
        .otherwise(F.concat(origin, F.when(below == "", F.lit("/")).otherwise(below), href))
    )


def extract_links(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """One row per anchor: position, href, whether it is a directory, full address.

    A trailing slash marks a directory; the parent link ``../`` is left out.
    """
    tags = F.regexp_replace(html, NO_TAGS, "")
    double = F.regexp_extract_all(tags, F.lit(ANCHOR), F.lit(1))
    single = F.regexp_extract_all(tags, F.lit(ANCHOR), F.lit(2))
    hrefs = F.zip_with(double, single, lambda a, b: F.when(a != "", a).otherwise(b))
    found = pages.select(key, url, F.posexplode(hrefs).alias("position", "href"))
    href = F.col("href")
    for name, character in ENTITIES.items():
        href = F.replace(href, F.lit(name), F.lit(character))
    found = found.withColumn("href", href).where(F.col("href") != "../")
    return found.select(
        key,
        "position",
        "href",
        F.when(F.col("href").endswith("/"), "directory").otherwise("file").alias("kind"),
        resolve(F.col(url), F.col("href")).alias("address"),
    )
