"""Benchmark decontamination: passages of benchmark items found in documents by a prefix-filtered join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperbrook.llm.common import ROW, ascii_lower, blocks, union_all, with_rows, without, written

WINDOW, SHINGLE = 10, 4
# Everything in ASCII but digits and lower-case letters parts words (fixed by the contract).
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY_BYTES, WINDOW_BYTES = 32, 400


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BETWEEN_WORDS), "")


def shingle(words: Column, at: Column, length: int) -> Column:
    """A hash of ``length`` words from position ``at``; equal hashes only make candidates."""
    return F.xxhash64(F.lit(length), *[F.get(words, at + F.lit(i)) for i in range(length)])


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(words, items): each distinct window of the items, with the sorted ids of the items that hold it."""
    items = benchmark.where("item_id is not null").select("item_id", word_array(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    parts = items.where(F.size("w") > 0).select("item_id", "w", F.explode(starts).alias("at"))
    parts = parts.select("item_id", F.slice("w", F.col("at") + 1, window).alias("words"))
    return parts.groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def window_shingles(windows: DataFrame, lengths: list[int]) -> DataFrame:
    """(words, items, offset, shingle) for all shingles of every window; short windows have one, of all words."""
    parts = []
    for length in lengths:
        own = windows.where(F.least(F.size("words"), F.lit(SHINGLE)) == length)
        offsets = F.explode(F.sequence(F.lit(0), F.size("words") - length))
        at = own.select("words", "items", offsets.alias("offset"))
        parts.append(at.withColumn("shingle", shingle(F.col("words"), F.col("offset"), length)))
    return union_all(parts)


def positions(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """(row, doc_id, words, n_words, pos, shingle): every word position of every document.

    The word array is only referred to by the rows that leave the generator, never copied, as long as what
    follows runs in the same stage.
    """
    split = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", word_array(F.col("text")).alias("words"))
    split = split.withColumn("n_words", F.size("words").cast("bigint"))
    at = split.select("row", "doc_id", "words", "n_words", F.posexplode_outer("words").alias("pos", "word"))
    hashes = [shingle(F.col("words"), F.col("pos"), length) for length in lengths]
    if len(hashes) == 1:
        return at.withColumn("shingle", hashes[0])
    return at.withColumn("shingle", F.explode(F.array(*hashes)))


def prefixes(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """(words, items, offset, shingle): of each window the shingle that is rarest in all documents.

    A document holds a window only if it holds all its shingles, so a prefix of one shingle in order of rarity is
    enough. Windows with a shingle that occurs nowhere are gone after this.
    """
    shingles = written(window_shingles(windows, lengths), "shingles")
    keys = shingles.select("shingle").distinct()
    counts = []
    for part in blocks(keys, "shingle", KEY_BYTES):
        met = positions(docs, lengths).select("shingle").join(F.broadcast(part), "shingle")
        counts.append(met.groupBy("shingle").agg(F.count("*").alias("n")))
    counted = shingles.join(written(union_all(counts), "counts"), "shingle", "left")
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")
    rarest = counted.groupBy("words").agg(F.first("items").alias("items"), F.min(order).alias("rarest"))
    found = rarest.where("rarest.n > 0").select("words", "items", "rarest.offset", "rarest.shingle")
    return written(found, "prefixes")


def covered(spans: Column) -> Column:
    """Words inside the union of (start, end) spans, given in order."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda state, span: F.struct(
            (state.n + F.greatest(span.end - F.greatest(span.start, state.reach), F.lit(0))).alias("n"),
            F.greatest(state.reach, span.end).alias("reach"),
        ),
        lambda state: state.n,
    )


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) for every row of ``docs`` (doc_id, text).

    A window is ``window`` consecutive words of an item, or all words of a shorter one. The windows' rarest
    shingles meet the documents' shingles; a window that would begin before the text or end after it is ruled out
    by position and length, and the rest is compared word by word. ``n_hit`` counts words inside any occurrence;
    ``items`` are the ids, as sorted strings, of the items with an occurring window.

    Null and empty texts have no words and no hits. Items without words or without an id take no part; items
    that repeat count once. Repeated documents and null ids give a row each. Other columns are not read. All
    documents meet one block of windows at a time (``BROADCAST_BYTES``), so a large benchmark means more scans.
    """
    windows = written(item_windows(benchmark, window), "windows")
    sizes = windows.select(F.least(F.size("words"), F.lit(SHINGLE)).alias("n")).distinct().collect()  # four at most
    lengths = sorted(row.n for row in sizes) or [SHINGLE]
    wanted = prefixes(docs, windows, lengths)
    start = F.col("pos") - F.col("offset")
    end = start + F.size("window")
    held = F.slice("words", F.greatest(start + 1, F.lit(1)), F.size("window"))
    parts = []
    for number, part in enumerate(blocks(wanted, "shingle", WINDOW_BYTES)):
        part = F.broadcast(part.withColumnRenamed("words", "window"))
        met = positions(docs, lengths).alias("d").join(
            part.alias("w"),
            (F.col("d.shingle") == F.col("w.shingle")) & (start >= 0) & (end <= F.col("n_words"))
            & (held == F.col("window")),
            "left",
        )
        # The first position stays without a hit too, so that each document comes out of this scan.
        first = F.coalesce(F.col("pos"), F.lit(0)) == 0 if number == 0 else F.lit(False)
        span = F.when(F.col("window").isNotNull(), F.struct(start.alias("start"), end.alias("end")))
        met = met.where(first | F.col("window").isNotNull())
        parts.append(met.select("row", "doc_id", "n_words", span.alias("span"), F.explode_outer("items").alias("item")))
    each = union_all(parts).groupBy("row", "doc_id", "n_words").agg(
        F.sort_array(F.collect_set("span")).alias("spans"),
        F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"),
    )
    n_hit = covered(F.col("spans")).cast("bigint")
    return each.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), "items",
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any window of an item, all columns as they are; each row by its own text."""
    rows = with_rows(docs)
    found = find_items(rows.select(F.struct(*ROW).alias("doc_id"), "text"), benchmark, window).where("contaminated")
    return without(rows, found.select("doc_id.*"), "contaminated")
