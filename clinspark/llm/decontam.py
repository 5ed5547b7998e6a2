"""Documents that hold a benchmark item: size-partitioned MinHash containment search, then an exact check.

DataFrame functions only.  Items are partitioned by size, and the items of a partition keep the same number of
smallest shingle hashes.  That number exceeds the shingles that an item may lack at the given containment, so a
document that holds enough of an item shares values of its sketch with certainty; how many is known too, and
pairs with fewer are not looked at again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.llm.store import stored

#: Sketches and candidates up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Sketch values that a partition keeps beyond those that an item may lack.
SPARE = 4
#: What separates words.
GAP = "[^\\p{L}\\p{N}]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), GAP), lambda w: w != "")


def _shingles(words: Column, n: int, of) -> Column:
    """``of`` every run of ``n`` words; of the whole sequence where there are fewer, none of an empty one."""
    runs = F.transform(
        F.array(words),
        lambda w: F.when(F.size(w) == 0, F.filter(F.array(of(w)), lambda x: F.lit(False)))
        .when(F.size(w) < n, F.array(of(w)))
        .otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))), lambda i: of(F.slice(w, i, n)))),
    )
    return F.element_at(runs, 1)


def _all_shingles(words: Column, n: int, short: list[int], of) -> Column:
    """As ``_shingles``, and every run of each of the lengths ``short``, for items that have no more words."""
    runs = [_shingles(words, n, of)]
    for k in short:
        none = F.filter(F.transform(words, lambda w: of(F.array(w))), lambda x: F.lit(False))
        runs.append(F.when(F.size(words) >= k, _shingles(words, k, of)).otherwise(none))
    return F.concat(*runs) if short else runs[0]


def _hashes(text: Column, n: int, short: list[int] = ()) -> Column:
    return _all_shingles(F.transform(_words(text), lambda w: F.xxhash64(w)), n, short, lambda w: F.xxhash64(w))


def _strings(text: Column, n: int, short: list[int] = ()) -> Column:
    return _all_shingles(_words(text), n, short, lambda w: F.array_join(w, " "))


def sketches(items: DataFrame, containment: float, shingle: int) -> DataFrame:
    """``(item_id, n, least, h)``: the sketch values of each item and how many of them a document must share.

    ``items`` has ``item_id`` and ``text``.  An item of ``n`` distinct shingles may lack ``n - ceil(containment * n)``; the
    partition of sizes up to a power of two keeps as many values as its largest item may lack, and a few more."""
    sized = items.select("item_id", F.array_sort(F.array_distinct(_hashes(F.col("text"), shingle))).alias("all")).withColumn("n", F.size("all")).filter("n > 0")
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.col("n")))).cast("int")
    # the small term keeps a product such as 0.8 * 25, which is a little over 20 in binary, at 20
    lack = lambda size: size - F.ceil(size * F.lit(containment) - F.lit(1e-9))
    kept = F.least(F.col("n"), (lack(upper) + F.lit(1 + SPARE)).cast("int"))
    return (
        sized.withColumns({"kept": kept, "lack": lack(F.col("n")).cast("int")})
        .select("item_id", "n", (F.col("kept") - F.col("lack")).alias("least"), F.explode(F.slice("all", F.lit(1), F.col("kept"))).alias("h"))
    )


def _small(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", containment: float = 0.8, shingle: int = 5) -> DataFrame:
    """``(doc_id, item_id, n_item, n_shared, containment)``: one row for each document and item of which the document holds
    at least that share of distinct shingles.

    Words are runs of letters and digits, lower-cased.  An item with fewer words than a shingle is one run of its own length, looked for
    wherever it stands; a text with fewer words has the whole sequence as its one shingle.  Null and wordless texts match
    nothing.  Items with equal words are one item under the smallest id, which is null where none of them has an id; different items that share an
    id, or have none, are searched by themselves, and a document may have a row for each.  Rows that repeat a document id or have none are
    one document under that id, whose shingles are those of all of them.  Other columns are not read."""
    doc = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("text is not null")
    # the key of an item is its place in a stored table, as ids may repeat or be missing
    item = stored(
        items.select(F.col(item_id).alias("name"), F.array_join(_words(F.col(item_text)), " ").alias("text"))
        .filter("text <> ''").groupBy("text").agg(F.min("name").alias("name"))
        .select(F.monotonically_increasing_id().alias("item_id"), "name", "text"),
        "items",
    )
    lengths = item.select(F.size(F.split("text", " ")).alias("n")).filter(F.col("n") < shingle).distinct()
    short = sorted(r["n"] for r in lengths.collect())
    sketch = stored(sketches(item, containment, shingle), "sketches")
    seen = doc.select("doc_id", F.explode(_hashes(F.col("text"), shingle, short)).alias("h"))
    if sketch.count() > BROADCAST_ROWS:
        # only hashes that some item keeps can match; the largest of them bounds what is shuffled
        top = sketch.agg(F.max("h").alias("top"))
        seen = seen.filter(F.col("h") <= top.select("top").scalar()).distinct()
    hits = (
        seen.join(_small(sketch), "h").groupBy("doc_id", "item_id", "h").agg(F.first("least").alias("least"))
        .groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("found"), F.first("least").alias("least"))
    )
    candidates = stored(hits.filter("found >= least").select(F.col("doc_id").alias("_doc"), "item_id"), "candidates")
    exact = item.select("item_id", "name", F.array_distinct(_strings(F.col("text"), shingle)).alias("whole"))
    wanted = candidates.join(exact, "item_id")
    held = doc.join(_small(candidates.select("_doc").distinct()), F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    pairs = (
        held.select("doc_id", F.array_distinct(_strings(F.col("text"), shingle, short)).alias("shingles"))
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")))
        .select("doc_id", "item_id", "name", F.size("whole").alias("n_item"), F.explode(F.array_intersect("whole", "shingles")).alias("s"))
    )
    return (
        pairs.distinct().groupBy("doc_id", "item_id", "name", "n_item").agg(F.count(F.lit(1)).alias("n_shared"))
        .filter(F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(containment) - F.lit(1e-9)))
        .select("doc_id", F.col("name").alias("item_id"), "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))
    )


ORACLE = """
WITH item AS (
  SELECT min(item_id) AS item_id, words, row_number() OVER () AS k FROM (
    SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS words FROM benchmark)
  WHERE len(words) > 0 GROUP BY words),
item_shingle AS (
  SELECT DISTINCT k, unnest(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS s FROM item),
doc AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS words FROM documents),
doc_shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS s FROM doc WHERE len(words) > 0
  UNION SELECT doc_id, unnest(list_transform(range(1, len(words) - n + 2), lambda i: array_to_string(words[i:i + n - 1], ' '))) AS s
  FROM doc JOIN (SELECT DISTINCT len(words) AS n FROM item WHERE len(words) < 5) ON len(words) >= n),
size AS (SELECT k, count(*) AS n_item FROM item_shingle GROUP BY k),
shared AS (SELECT doc_id, k, count(*) AS n_shared FROM doc_shingle JOIN item_shingle USING (s) GROUP BY doc_id, k)
SELECT doc_id, item_id, n_item, n_shared, n_shared::DOUBLE / n_item AS containment
FROM shared JOIN size USING (k) JOIN item USING (k) WHERE n_shared >= ceil(n_item * 0.8::DOUBLE - 1e-9)
"""
