"""Lines that a large share of the pages of one site repeat.

DataFrame functions only.  Counting works on line hashes and is checked on the lines themselves afterwards; the text
is never shuffled by line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.llm.store import stored

#: Candidate lines and boilerplate text up to these sizes are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 100_000
BROADCAST_CHARS = 8_000_000
#: Standard deviations over the ratio from which a line on few pages counts.
FEW_Z = 2.5


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _surely_over(n: Column, pages: Column, ratio: float, z: float) -> Column:
    """Whether ``n`` of ``pages`` pages show a share over ``ratio``, ``z`` standard deviations of a line with just that share away."""
    over = n.cast("double") - F.lit(ratio) * pages
    return (n >= 2) & (over > 0) & (over * over > F.lit(z) * F.lit(z) * F.lit(ratio) * F.lit(1 - ratio) * pages)


def boilerplate(pages: DataFrame, host: str = "host", text: str = "text", ratio: float = 0.08, min_pages: int = 5, few_z: float | None = FEW_Z) -> DataFrame:
    """``(host, lines)``: the lines whose share of the host's pages is over ``ratio``.

    On ``min_pages`` pages or more the share itself decides.  On fewer, where chance alone may lift it, a line counts that is on two different
    pages at least and surely over the ratio: by ``few_z`` standard deviations of a line with just that share.  There pages of one
    text count once, as copies share every line.  So a line on two of five pages counts, and on two of twenty does not.  Without
    ``few_z`` lines on fewer than ``min_pages`` pages never count.

    A page counts once for a line however often it repeats it.  Lines are compared without outer
    spaces, blank ones never count.  A host has at most (lines per page) / ``ratio`` such lines."""
    few = few_z is not None
    page = pages.select(F.col(host).alias("host"), F.col(text).alias("text")).filter("host is not null")
    copies = [F.xxhash64("text").alias("copy")] if few else []
    total = page.select("host", *copies).groupBy("host").agg(F.count(F.lit(1)).alias("pages"), *([F.count_distinct("copy").alias("texts")] if few else []))
    filled = F.filter(F.transform(_lines(F.col("text")), lambda x: F.trim(x)), lambda x: x != "")
    hashed = page.select("host", F.explode(F.array_distinct(F.transform(filled, lambda x: F.xxhash64(x)))).alias("h"))
    frequent = (F.col("n") >= min_pages) & (F.col("n").cast("double") > F.lit(ratio) * F.col("pages"))
    # a line is on no more different texts than pages
    likely = frequent | _surely_over(F.col("n"), F.col("texts"), ratio, few_z) if few else frequent
    common = stored(
        hashed.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= (min(min_pages, 2) if few else min_pages))
        .join(total, "host").filter(likely).select("host", "h", "pages", *(["texts", (~frequent).alias("few")] if few else [])),
        "common-lines",
    )
    if common.count() <= BROADCAST_ROWS:
        common = F.broadcast(common)
    lines = page.select("host", *copies, F.explode(F.array_distinct(filled)).alias("line")).withColumn("h", F.xxhash64("line"))
    sums = [F.count(F.lit(1)).alias("n"), F.first("pages").alias("pages")]
    if few:
        sums += [F.count_distinct(F.when(F.col("few"), F.col("copy"))).alias("on"), F.first("texts").alias("texts")]
    sure = frequent | _surely_over(F.col("on"), F.col("texts"), ratio, few_z) if few else frequent
    return (
        lines.join(common, ["host", "h"]).groupBy("host", "line").agg(*sums)
        .filter(sure).groupBy("host").agg(F.collect_list("line").alias("lines"))
    )


def without_boilerplate(pages: DataFrame, host: str = "host", text: str = "text", ratio: float = 0.08, min_pages: int = 5, added: tuple[str, ...] = ("n_lines", "n_dropped"), few_z: float | None = FEW_Z) -> DataFrame:
    """``pages`` with the boilerplate lines of their host cut out of ``text``; the numbers of lines and of dropped lines are added
    under the names in ``added``, if it has any.

    Every row stays, and so do its other columns.  A null text stays null and has no lines; an empty one has none.
    Pages without a host are left as they are.  An added column replaces one of the same name."""
    found = stored(boilerplate(pages, host, text, ratio, min_pages, few_z), "boilerplate")
    chars = found.agg(F.sum(F.aggregate("lines", F.lit(0), lambda s, x: s + F.length(x)))).first()[0] or 0
    found = found.select(F.col("host").alias("_host"), F.col("lines").alias("_boilerplate"))
    if chars <= BROADCAST_CHARS:
        found = F.broadcast(found)
    parts = _lines(F.col(text))
    none = F.array().cast("array<string>")
    kept = F.filter(parts, lambda x: ~F.array_contains(F.coalesce(F.col("_boilerplate"), none), F.trim(x)))
    filled = F.size(F.filter(parts, lambda x: F.trim(x) != ""))
    dropped = F.size(parts) - F.size(kept)
    counts = [F.when(F.col(text).isNull(), 0).otherwise(n) for n in (filled, dropped)]
    new = dict(zip(added, counts, strict=False)) | {text: F.array_join(kept, "\n")}
    return pages.join(found, F.col(host) == F.col("_host"), "left").withColumns(new).drop("_host", "_boilerplate")


#: Fixed patterns: markup that holds no text, markup that ends a line, any other markup, the host of a URL.
HIDDEN = "(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
BREAK = "(?i)</?(?:p|div|li|ul|ol|nav|article|section|header|footer|h[1-6]|table|tr|td|th|title|head|body|html|br)(?:[ \\t\\r\\n/][^>]*)?>"
MARKUP = "<[^>]*>"
HOST = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def page_lines(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``host`` (null where the URL names none) and ``text``, one line for each block of the page."""
    host = F.lower(F.regexp_extract(F.col(url), HOST, 1))
    shown = F.regexp_replace(F.col(html), HIDDEN, "")
    text = F.regexp_replace(F.regexp_replace(shown, BREAK, "\n"), MARKUP, "")
    return pages.withColumns({"host": F.when(host != "", host), "text": text})


ORACLE = f"""
WITH page AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '{HOST}', 1)), '') AS host,
         regexp_replace(regexp_replace(regexp_replace(html, '{HIDDEN}', '', 'g'), '{BREAK.replace(chr(92) + "t", chr(9))}', chr(10), 'g'), '{MARKUP}', '', 'g') AS text
  FROM pages),
total AS (SELECT host, count(*) AS pages, count(DISTINCT text) AS texts FROM page WHERE host IS NOT NULL GROUP BY host),
line AS (SELECT page_id, host, text, unnest(list_distinct(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''))) AS line
         FROM page WHERE host IS NOT NULL),
seen AS (SELECT line.host, line.line, count(*) AS n, count(DISTINCT text) AS n_texts, any_value(pages) AS pages, any_value(texts) AS texts
         FROM line JOIN total ON line.host = total.host GROUP BY line.host, line.line),
boiler AS (SELECT host, list(line) AS lines FROM seen
  WHERE (n >= 5 AND n > 0.08 * pages) OR (n_texts >= 2 AND n_texts > 0.08 * texts
         AND (n_texts - 0.08 * texts) ** 2 > {FEW_Z} * {FEW_Z} * 0.08 * 0.92 * texts) GROUP BY host),
cut AS (SELECT page.page_id, page.host, string_split(text, chr(10)) AS parts,
               list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(lines, []), trim(x))) AS kept
        FROM page LEFT JOIN boiler ON page.host = boiler.host)
SELECT page_id, host, coalesce(len(list_filter(parts, lambda x: trim(x) <> '')), 0) AS n_lines,
       coalesce(len(parts) - len(kept), 0) AS n_dropped, array_to_string(kept, chr(10)) AS text
FROM cut
"""
