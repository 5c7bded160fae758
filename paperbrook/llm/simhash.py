"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperbrook.llm.common import ROW, slices, with_rows, without, written
from paperbrook.llm.components import components

HASH_SEED = 42
# Buckets of more members than this leave the task that would compare all their pairs.
DENSE = 4096
# Multipliers that turn one shingle hash into further independent ones (fixed odd numbers).
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64)


def shingle_hashes(text: bytes | None, words_each: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of the lower-cased words of a text, repeats included."""
    import xxhash

    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) <= words_each:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)], dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    grams = zip(*(words[at:] for at in range(words_each)), strict=False)
    return np.fromiter((digest(g, HASH_SEED) for g in map(b" ".join, grams)), np.uint64, len(words) - words_each + 1)


def fingerprint(hashes: np.ndarray, mixed: int = 0) -> int:
    """The signed 64-bit word whose bit is 1 where more than half of the hashes have it."""
    total = np.zeros(64, dtype=np.int64)
    for part in slices(len(hashes), 1 << 16):
        values = hashes[part]
        if mixed:
            values = (values ^ (values >> np.uint64(31))) * MIX[mixed % len(MIX)]
            values ^= values >> np.uint64(29)
        total += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words_each: int = 4, words: int = 1, keyed: bool = False) -> DataFrame:
    """(doc_id, f0, f1, ...) for every row, null and empty texts included: those have zero fingerprints.

    With ``keyed`` the other columns as a string and the row's key come after the doc_id. Each 64-bit word comes from its own mixing of the same shingle hashes; the first is the plain hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [fingerprint(hashes, at) for at in range(words)]
                for hashes in (shingle_hashes(t, words_each) for t in batch.column(1).cast(pa.binary()).to_pylist())
            ]
            columns = [pa.array([row[at] for row in rows], pa.int64()) for at in range(words)]
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, *columns], [*names, *(f"f{at}" for at in range(words))])

    names = ["doc_id", "rest", *ROW] if keyed else ["doc_id"]
    kinds = [f"{name} {'string' if name == 'rest' else 'bigint'}" for name in [*names, *(f"f{at}" for at in range(words))]]
    rest = F.struct(*[c for c in docs.columns if c not in ("doc_id", "text", *ROW)] or [F.lit(0)]).cast("string").alias("rest")
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *([rest, *ROW] if keyed else []))
    return given.mapInArrow(run, ", ".join(kinds))


def covering_masks(bits: int, radius: int, seed: int = 1) -> list[int]:
    """Masks of which at least one is zero at all of any ``radius`` bit positions.

    Every position gets a non-zero vector of radius + 1 bits, all vectors equally often; there is one mask for
    each non-zero vector v, with a bit wherever the position's vector has an odd overlap with v. The vectors of
    ``radius`` positions leave some v orthogonal to all of them, and that mask keeps none of these positions.
    """
    size = 1 << (radius + 1)
    vectors = np.random.default_rng(seed).permutation(np.arange(bits) % (size - 1) + 1)
    return [sum(1 << at for at in range(bits) if (int(vectors[at]) & v).bit_count() & 1) for v in range(1, size)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def distance(a: list[Column], b: list[Column]) -> Column:
    return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b, strict=True)), F.lit(0))


def linked_pairs(nodes: np.ndarray, signatures: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the members of one bucket, found by comparing all of them here."""
    root = np.arange(len(nodes))
    found = []
    for at in range(len(nodes) - 1):
        far = np.bitwise_count(signatures[at + 1 :] ^ signatures[at]).sum(1, dtype=np.int64)
        for other in np.flatnonzero(far <= radius) + at + 1:
            if root[at] != root[other]:
                root[root == root[other]] = root[at]
                found.append((nodes[at], nodes[other]))
    return found


def in_buckets(members: DataFrame, radius: int, words: int) -> DataFrame:
    """Links (a, b) among the members (bucket, node, f0, ...) of each bucket.

    A bucket's rows stand together after the sort and are compared as they come by; those of two all at once.
    """

    def compare(columns: list[np.ndarray]) -> pa.RecordBatch:
        bucket, nodes, signatures = columns[0], columns[1], np.column_stack(columns[2:]).view(np.uint64)
        starts = np.append(0, np.flatnonzero(np.diff(bucket)) + 1)
        ends = np.append(starts[1:], len(bucket))
        two = starts[ends - starts == 2]
        near = two[np.bitwise_count(signatures[two] ^ signatures[two + 1]).sum(1, dtype=np.int64) <= radius]
        a, b = [nodes[near]], [nodes[near + 1]]
        for start, end in zip(starts[ends - starts > 2], ends[ends - starts > 2], strict=True):
            pairs = np.array(linked_pairs(nodes[start:end], signatures[start:end], radius), np.int64).reshape(-1, 2)
            a.append(pairs[:, 0])
            b.append(pairs[:, 1])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (a, b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = [c.to_numpy() for c in batch.columns]
            held = fresh if held is None else [np.concatenate(x) for x in zip(held, fresh, strict=True)]
            last = int(np.searchsorted(held[0], held[0][-1]))  # the last bucket may go on in the next batch
            if last:
                yield compare([c[:last] for c in held])
                held = [c[last:] for c in held]
        if held is not None:
            yield compare(held)

    columns = ["bucket", "node", *(f"f{at}" for at in range(words))]
    dealt = members.select(*columns).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def ball_links(nodes: DataFrame, radius: int) -> DataFrame:
    """Exact links of dense buckets of single fingerprints without comparing pairs.

    Two words differ in at most ``radius`` bits if and only if some word lies within half of it of both (the
    rounded-up half of one, the rounded-down half of the other). Each word is posted under all words within the
    larger half; those that meet under one word are compared only with the smallest of its inner half.
    """
    inner, outer = radius // 2, radius - radius // 2

    def ball(reach: int) -> Column:
        flips = [0]
        for _ in range(reach):
            flips = sorted({f ^ (1 << at) for f in flips for at in range(64)} | set(flips))
        return F.explode(F.array(*[F.lit(signed(f)) for f in flips]))

    def posted(reach: int) -> DataFrame:
        flipped = nodes.select("f0", ball(reach).alias("flip"))
        return flipped.select("f0", F.col("f0").bitwiseXOR(F.col("flip")).alias("centre"))

    least = posted(inner).groupBy("centre").agg(F.min("f0").alias("b"))
    return posted(outer).join(least, "centre").select(F.col("f0").alias("a"), "b").where("a <> b").distinct()


def dense_pairs(members: DataFrame, radius: int, words: int, block: int) -> DataFrame:
    """Links of dense buckets of several words: blocks of members meet two by two, each pair of blocks in a task."""
    columns = ["node", *(f"f{at}" for at in range(words))]
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = members.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = own.withColumn("other", F.explode(others)).select(
        "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), *columns
    )
    together = dealt.withColumn("bucket", F.xxhash64("bucket", "i", "j")).distinct()
    return in_buckets(together, radius, words)


def links(
    classes: DataFrame, words: int, bits: int, table_radius: int, link_radius: int, dense: int = DENSE
) -> DataFrame:
    """Links (a, b) between distinct signatures (node, f0, f1, ...), enough to connect all that are linked.

    Every pair that differs in at most ``table_radius`` of the first ``bits`` bits of any word meets in a table
    and is compared over all words. Members of a bucket are compared within a task; of a bucket beyond ``dense``
    members by :func:`ball_links` or :func:`dense_pairs`, so none is skipped.
    """
    columns = ["node", *(f"f{at}" for at in range(words))]
    keys = []
    for word in range(words):
        for number, mask in enumerate(covering_masks(bits, table_radius, seed=word + 1)):
            kept = F.col(f"f{word}").bitwiseAND(F.lit(signed(mask)))
            keys.append(F.xxhash64(F.lit(word * 1000 + number), kept))
    buckets = classes.select(*columns, F.explode(F.array(*keys)).alias("bucket"))
    large = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > dense)
    large = written(large, "buckets")
    if large.isEmpty():
        return in_buckets(buckets, link_radius, words)
    pairs = in_buckets(buckets.join(large, "bucket", "left_anti"), link_radius, words)
    crowded = written(buckets.join(large, "bucket"), "dense")
    if words == 1 and bits == 64 and table_radius == link_radius:
        return pairs.union(ball_links(crowded.select("f0").distinct(), link_radius))
    return pairs.union(dense_pairs(crowded, link_radius, words, dense // 2))


def near_duplicates(
    docs: DataFrame, words_each: int = 4, words: int = 1, bits: int = 64, table_radius: int = 4, link_radius: int = 4,
    dense: int = DENSE, keyed: bool = False,
) -> DataFrame:
    """(doc_id, f0, ..., component_id) for every row of ``docs`` (doc_id, text).

    Rows with equal signatures are one class; classes are linked by at most ``link_radius`` differing bits.
    ``component_id`` is the smallest doc_id reachable. Null and empty texts have the zero fingerprint and are
    linked like any other; rows with a null doc_id get the component of their class, null if no row of it has an
    id. Repeated rows give repeated results. Other columns are not read. With ``keyed``, for rows with keys, there are
    the row's key and its other columns as a string ``rest`` too, and ``component_id`` is the first of doc_id, null
    last, ``rest`` and key (none, doc_id, rest, key).
    """
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rest", *ROW) if keyed else F.col("doc_id")
    sign = [f"f{at}" for at in range(words)]
    prints = written(fingerprints(docs, words_each, words, keyed), "fingerprints")
    node = F.col("f0") if words == 1 else F.xxhash64(*sign)
    classes = prints.groupBy(*sign).agg(F.min(first).alias("first_id")).withColumn("node", node)
    classes = written(classes, "classes")
    roots = components(links(classes, words, bits, table_radius, link_radius, dense))
    placed = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(placed.join(least, "root").select(*sign, "component_id"), "named")
    return prints.join(named, sign)


def keep_firsts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the first of their group of :func:`near_duplicates`, all columns as they are.

    Shingle length and bit distance are those of the operator. One row of a group stays: the smallest id, rows without an
    id last, then the least by the other columns as a string, then any one of equal rows. Rows of an empty table stay
    none; null and empty texts are one group.
    """
    rows = with_rows(docs)
    found = near_duplicates(rows, keyed=True)
    later = F.struct(*ROW) != F.struct(*(F.col(f"component_id.{c}") for c in ROW))
    return without(rows, found.where(later), "later")
