"""Benchmark decontamination by size-partitioned MinHash containment search.

Benchmark items are put into partitions by the power of two of their number of
distinct word shingles. An item's signature is its bottom-k MinHash: the k
shingles with the smallest hashes. k belongs to the partition: it is one more
than the shingles that the largest item of the partition may lack at the wanted
containment. So at least one signature member of every item that is contained
enough stands in the document, however long the document is, and the search
misses nothing. The documents have no signature of their own: a short item would
be too small a part of it. What this comes to is an exact prefix filter in the
order of the hashes. Candidates are then held against all of the
item's shingles, as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.session import materialise

WORDS = 5
PERCENT = 80
#: What divides words: anything but letters and digits of any script.
NOT_WORD = r"[^\p{L}\p{N}]+"


def _word_array(text: Column) -> Column:
    """Words in lower case, without punctuation; none for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD, -1), "")


def _at(words: Column, i: Column, n: int) -> list[Column]:
    return [F.get(words, i + k) for k in range(n)]


def _explode_hashes(docs: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """(key, h): the hash of every run of as many words as lengths say.

    One generator over positions; the word array is not copied for a position.
    """
    w, i = F.col("_words"), F.col("_i")
    base = docs.select(F.col(key), _word_array(F.col("text")).alias("_words"))
    shortest = min(lengths)
    at = F.when(F.size(w) >= shortest, F.sequence(F.lit(0), F.size(w) - shortest)).otherwise(F.array().cast("array<int>"))
    rows = base.select(key, "_words", F.explode(at).alias("_i"))
    if len(lengths) == 1:
        return rows.select(key, F.xxhash64(*_at(w, i, shortest)).alias("h"))
    each = [F.when(i + n <= F.size(w), F.xxhash64(*_at(w, i, n))) for n in lengths]
    return rows.select(key, F.explode(F.array(*each)).alias("h")).where("h is not null")


def _explode_texts(docs: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """(key, shingle): as _explode_hashes, with the words themselves."""
    w, i = F.col("_words"), F.col("_i")
    base = docs.select(F.col(key), _word_array(F.col("text")).alias("_words"))
    shortest = min(lengths)
    at = F.when(F.size(w) >= shortest, F.sequence(F.lit(0), F.size(w) - shortest)).otherwise(F.array().cast("array<int>"))
    rows = base.select(key, "_words", F.explode(at).alias("_i"))
    each = [F.when(i + n <= F.size(w), F.concat_ws(" ", *_at(w, i, n))) for n in lengths]
    return rows.select(key, F.explode(F.array(*each)).alias("shingle")).where("shingle is not null")


def contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """Pairs of a document and a benchmark item whose shingles it contains to percent or more.

    docs needs doc_id and text, items needs item_id and text; other columns are
    ignored. Returns doc_id, item_id, n_shared, n_item (distinct shingles that
    are shared, that the item has) and containment.

    Words are runs of letters and digits in lower case. An item with fewer than
    `words` words is one shingle of all its words. Items or documents without
    words or text match nothing; empty tables give no rows. Rows with one
    doc_id, or one item_id, count as one text whose shingles are united. Rows
    with a null id are left out, as no pair could name them. If the benchmark is
    too large to broadcast, the planner shuffles (doc_id, hash) instead.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    id_type = items.schema["item_id"].dataType
    items = items.select("item_id", _word_array(F.col("text")).alias("w")).where("item_id is not null and size(w) > 0")
    n = F.least(F.size("w"), F.lit(words))
    starts = F.sequence(F.lit(0), F.size("w") - n)
    pieces = items.select("item_id", n.alias("len"), F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, n))).alias("p"))
    pieces = pieces.select("item_id", "len", F.xxhash64(*[F.get("p", F.lit(k)) for k in range(words)]).alias("_padded"), F.array_join("p", " ").alias("shingle"), "p")
    pieces = materialise(pieces.dropDuplicates(["item_id", "shingle"]))
    lengths = sorted(r[0] for r in pieces.select("len").distinct().collect())  # `words` values at most
    if not lengths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_shared long, n_item long, containment double").select(
            F.col("doc_id").cast(docs.schema["doc_id"].dataType), F.col("item_id").cast(id_type), "n_shared", "n_item", "containment"
        )

    hashed = pieces.select("item_id", "shingle", F.coalesce(*[F.when(F.col("len") == k, F.xxhash64(*[F.get("p", F.lit(j)) for j in range(k)])) for k in lengths]).alias("h"))
    per_item = hashed.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"), F.sort_array(F.collect_set("h")).alias("hs"))
    largest = F.pow(F.lit(2), F.floor(F.log2("n_item")) + 1) - 1
    k = F.floor(largest * (100 - percent) / 100).cast("int") + 1
    signatures = materialise(per_item.select("item_id", F.explode(F.slice("hs", F.lit(1), k)).alias("h")))

    found = _explode_hashes(docs, "doc_id", lengths).join(signatures, "h").select("doc_id", "item_id").distinct()
    candidates = materialise(found)

    index = materialise(pieces.join(per_item.select("item_id", "n_item"), "item_id").select("item_id", "n_item", "shingle"))
    near = docs.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    shared = _explode_texts(near, "doc_id", lengths).join(index, "shingle").join(candidates, ["doc_id", "item_id"], "left_semi")
    counted = shared.groupBy("doc_id", "item_id", "n_item").agg(F.count_distinct("shingle").alias("n_shared"))
    return counted.where(F.col("n_shared") * 100 >= F.col("n_item") * percent).select(
        "doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment")
    )


def clean_documents(docs: DataFrame, items: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """docs without those that contain a benchmark item. Rows with a null doc_id stay."""
    bad = materialise(contaminated(docs, items, percent, words).select("doc_id").distinct())
    return docs.join(bad, docs["doc_id"] == bad["doc_id"], "left_anti")
