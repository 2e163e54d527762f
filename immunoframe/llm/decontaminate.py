"""Benchmark decontamination: size-partitioned MinHash containment search, in built-in functions only.

A test item is found in a document when at least ``SIMILARITY`` per cent of the item's
distinct word shingles (five words; shorter items count as one shingle of their own length)
are the document's too. Items are partitioned by size (powers of two). The sketch of an item
is its ``k`` smallest shingle hashes (bottom-k MinHash), where k is somewhat more than twice the
shingles that an item of its partition can miss; a document that holds enough of an item
misses no more of the sketch than of the item, however long the document is, so asking for the rest
of the sketch loses no match and passes few documents that share a common phrase.
A document's distinct shingles are looked up in the sketches by an equality join on the hash and
counted for (document, item) before the shuffle; documents that are too small for the item go,
and the rest is verified by intersecting the exact shingles.

The sketches hold about half of the items' shingles; Spark broadcasts them where their size
allows it and shuffles both sides otherwise. Texts are never shuffled for the search; the
verification reads the candidates' texts again.

Words are maximal runs of letters and digits of the lower-cased text.

Defined cases: null or wordless texts and items match nothing; rows that share a doc_id are
judged one by one and their best containment is reported; repeated items are reported by
each of their ids; an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

WIDTH = 5
SIMILARITY = 80


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def let(value: Column, body) -> Column:
    """body(value) with value worked out once: as a lambda's argument no optimizer rule can copy it to each of its uses."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(words: Column, width: int = WIDTH) -> Column:
    """Hashes of all runs of ``width`` words; empty where there are fewer."""
    at = F.sequence(F.lit(0), F.size(words) - width)
    each = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    return F.when(F.size(words) >= width, each).otherwise(F.array().cast("array<bigint>"))


def shingle_texts(words: Column, width: Column) -> Column:
    """The distinct runs of ``width`` words as strings."""
    at = F.sequence(F.lit(1), F.size(words) - width + 1)
    each = F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice(words, i, width), " ")))
    return F.when(F.size(words) >= width, each).otherwise(F.array().cast("array<string>"))


def sketches(items: DataFrame, key: str, text: str) -> DataFrame:
    """item, width, n (distinct shingles), the sketch and how much of it a match holds at least, of each item that has a word."""
    w = F.col("_w")
    own = items.select(F.col(key).alias("item"), words_of(F.col(text)).alias("_w")).where(F.size(w) > 0)
    parts = [own.where(F.size(w) >= WIDTH).select("item", F.lit(WIDTH).alias("width"), F.array_distinct(shingle_hashes(w)).alias("h"))]
    parts += [own.where(F.size(w) == k).select("item", F.lit(k).alias("width"), shingle_hashes(w, k).alias("h")) for k in range(1, WIDTH)]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    n = F.size("h")
    largest = F.pow(F.lit(2), F.ceil(F.log2(n.cast("double"))))  # the partition: sizes up to this power of two
    share = (100 - SIMILARITY) / 100
    kept = F.least(n, (2 * F.floor(largest * share) + 4).cast("int"))
    need = kept - F.floor(n * (100 - SIMILARITY) / 100).cast("int")
    return found.select("item", "width", n.alias("n"), F.slice(F.sort_array("h"), 1, kept).alias("sketch"), need.alias("need"))


def candidates(docs: DataFrame, items: DataFrame, key: str, text: str, item_key: str, item_text: str) -> DataFrame:
    """Distinct (doc, item, width) that share enough of the sketch and pass the size bound."""
    own = staged(sketches(items, item_key, item_text), "sketches")
    probe = own.select("item", "width", "n", "need", F.explode("sketch").alias("hash"))
    widths = [r.width for r in own.select("width").distinct().collect()]  # at most five
    w = F.col("_w")
    texts = docs.select(F.col(key).alias("doc"), words_of(F.col(text)).alias("_w"))
    found = None
    for width in sorted(widths) or [WIDTH]:
        rows = texts.select("doc", F.size(w).alias("_size"), F.explode(F.array_distinct(shingle_hashes(w, width))).alias("hash"))
        some = rows.join(probe.where(F.col("width") == width), "hash").where((F.col("_size") - width + 1) * 100 >= F.col("n") * SIMILARITY)
        some = some.groupBy("doc", "item", "width", "need").agg(F.count("*").alias("hits")).where("hits >= need").select("doc", "item", "width")
        found = some if found is None else found.unionByName(some)
    return found


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """key, item_key, n_item (the item's shingles), n_shared and containment of every verified match."""
    found = staged(candidates(docs, items, key, text, item_key, item_text), "leak-candidates")
    wanted = found.join(
        items.select(F.col(item_key).alias("_i"), words_of(F.col(item_text)).alias("_iw")), F.col("item").eqNullSafe(F.col("_i"))
    ).select("doc", "item", "width", let(F.col("_iw"), lambda w: shingle_texts(w, F.col("width"))).alias("_is"))
    texts = docs.select(F.col(key).alias("_d"), F.col(text).alias("_t")).join(
        found.select("doc").distinct(), F.col("_d").eqNullSafe(F.col("doc")), "left_semi")
    both = texts.join(wanted, F.col("_d").eqNullSafe(F.col("doc")))
    own = let(words_of(F.col("_t")), lambda w: F.size(F.array_intersect("_is", shingle_texts(w, F.col("width")))))
    shared = both.select("doc", "item", F.size("_is").alias("n_item"), own.alias("n_shared"))
    best = shared.where(F.col("n_shared") * 100 >= F.col("n_item") * SIMILARITY).groupBy("doc", "item", "n_item").agg(F.max("n_shared").alias("n_shared"))
    return best.select(
        F.col("doc").alias(key), F.col("item").alias(item_key), F.col("n_item").cast("long").alias("n_item"),
        F.col("n_shared").cast("long").alias("n_shared"), F.round(F.col("n_shared") / F.col("n_item"), 6).alias("containment"))


def drop_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that hold no test item, with all their columns.

    Rows are told apart by their text's digest, not by key: ids may be null or shared by other texts.
    """
    digest = lambda t: F.unhex(F.sha2(t, 256))
    own = docs.select(digest(F.col(text)).alias("_row"), F.col(text).alias("_text"))
    found = staged(leaks(own, items, "_row", "_text").select(F.col("_row").alias("_leak")).distinct(), "leaks")
    return docs.join(found, digest(docs[text]) == found["_leak"], "left_anti")
