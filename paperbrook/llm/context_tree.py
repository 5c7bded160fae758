"""Language-model scores by context-tree weighting over bytes, beside add-one word counts."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperbrook.llm.common import written

# Bytes of the longest context; bytes of text whose grams and words are asked for together.
DEPTH, BLOCK_BYTES = 4, 16 << 20
# Stands for the end of a text and for what is before it; no UTF-8 text holds this byte.
END = 0xFF
# The token that ends a text; no word holds a line feed.
END_TOKEN = b"\n"
HALF = float(np.log(0.5))
# Bytes of a pack of texts, whose grams are taken together; distinct grams that wait to be merged.
CUT, WAITING = 1 << 20, 1 << 19
ASKED = "block bigint, gram bigint, word binary, n bigint"
SCORED = (
    "block bigint, row bigint, doc_id bigint, n_tokens bigint, n_known bigint, n_bytes bigint, known_log double, score double"
)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """The logarithm of the gamma function, by Stirling's series ten places on."""
    far = x + 10
    value = (far - 0.5) * np.log(far) - far + 0.5 * np.log(2 * np.pi)
    value += 1 / (12 * far) - 1 / (360 * far**3) + 1 / (1260 * far**5) - 1 / (1680 * far**7)
    return value - sum(np.log(x + i) for i in range(10))


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What Krichevsky and Trofimov's estimate gives a string of ``a`` zeros and ``b`` ones, as a logarithm."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - np.log(np.pi)


def sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, values, size).astype(np.float64)  # without values it counts in integers


class Level(NamedTuple):
    """The nodes of one depth: context and place in the byte's bit tree as one key, zeros, ones, the logarithm of the
    weighted probability, and for each node of the next depth its node here."""

    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray
    below: np.ndarray

    def mixed(self, deeper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each node below: the share of this depth times its chance of a one, and the share left for ``deeper``."""
        own = np.exp(np.minimum(HALF + log_kt(self.zeros, self.ones) - self.weighted, 0.0))
        one = (self.ones + 0.5) / (self.zeros + self.ones + 1.0)
        return (own * one)[deeper], (1 - own)[deeper]


def leaves(grams: np.ndarray, counts: np.ndarray) -> tuple[Level, np.ndarray]:
    """The nodes of the longest contexts, and for each gram the eight nodes of its last byte, first bit first.

    A gram holds the bytes of its context, the last one first, and then the byte that follows. The places in the bit
    tree are numbered as in a heap: 1 for the first bit, and 2u or 2u + 1 after a zero or a one at u.
    """
    byte = grams & 0xFF
    keys = np.stack([(grams >> 8 << 8) | (1 << j) | (byte >> (8 - j)) for j in range(8)], axis=1)
    ones = np.stack([byte >> (7 - j) & 1 for j in range(8)], axis=1).astype(bool)
    key, node = np.unique(keys, return_inverse=True)
    node = node.reshape(keys.shape)
    n = np.broadcast_to(counts[:, None], keys.shape).astype(np.float64)
    b = sums(node[ones], n[ones], len(key))
    a = sums(node[~ones], n[~ones], len(key))
    return Level(key, a, b, log_kt(a, b), np.zeros(0, np.int64)), node


def shorter(level: Level) -> Level:
    """The nodes of the contexts without their first byte. A node weighs its own estimate and the product of the
    weighted probabilities of the nodes below it half and half."""
    key, below = np.unique(level.key >> 16 << 8 | level.key & 0xFF, return_inverse=True)
    a, b = (sums(below, v, len(key)) for v in (level.zeros, level.ones))
    product = sums(below, level.weighted, len(key))
    return Level(key, a, b, np.logaddexp(HALF + log_kt(a, b), HALF + product), below)


def levels_of(grams: np.ndarray, counts: np.ndarray, depth: int, stop: int) -> tuple[list[Level], np.ndarray]:
    """Nodes of the depths from ``depth`` up to ``stop``, and the leaves of each gram."""
    first, node = leaves(grams, counts)
    found = [first]
    for _ in range(depth - stop):
        found.append(shorter(found[-1]))
    return found, node


def ones_below(levels: list[Level]) -> np.ndarray:
    """For each leaf the chance of a one, mixed over the depths of ``levels`` on its path."""
    chance = (levels[0].ones + 0.5) / (levels[0].zeros + levels[0].ones + 1.0)
    above = np.arange(len(chance))
    for level in levels[1:]:
        above = level.below[above]
        share, rest = level.mixed(above)
        chance = share + rest * chance
    return chance


def log_chance(node: np.ndarray, byte: np.ndarray, one: np.ndarray) -> np.ndarray:
    """The logarithm of the chance of each byte, from the chances of a one at its eight nodes."""
    bits = np.stack([byte >> (7 - j) & 1 for j in range(8)], axis=1).astype(bool)
    p = one[node]
    return np.log(np.where(bits, p, 1 - p)).sum(1)


class GramTable:
    """Values by gram in open addressing, looked up a whole array at a time; every gram asked for must be there."""

    def __init__(self, grams: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(3 * len(grams)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits)
        at = self.place(grams)
        while len(grams):
            free = self.keys[at] < 0
            self.keys[at[free]] = grams[free]  # of several at one place one stays
            stays = self.keys[at] == grams
            self.values[at[stays]] = values[stays]
            grams, values, at = grams[~stays], values[~stays], (at[~stays] + 1) & (len(self.keys) - 1)

    def place(self, grams: np.ndarray) -> np.ndarray:
        mixed = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, grams: np.ndarray) -> np.ndarray:
        at = self.place(grams)
        wrong = np.flatnonzero(self.keys[at] != grams)
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.keys) - 1)
            wrong = wrong[self.keys[at[wrong]] != grams[wrong]]
        return self.values[at]


class Top(NamedTuple):
    """Depths 0 and 1, where the contexts of two bytes end: for each node of depth 1 what the two add, and leave."""

    key: np.ndarray
    share: np.ndarray
    rest: np.ndarray

    def mix(self, keys: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """The chances below nodes of depth 1 with these keys, mixed with those of the depths above."""
        at = np.searchsorted(self.key, keys)
        return self.share[at] + self.rest[at] * chance


def top_of(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, product: np.ndarray) -> Top:
    """From the nodes of depth 1: counts, and the sum of the weighted logarithms below each."""
    order = np.argsort(key)
    key, zeros, ones, product = key[order], zeros[order], ones[order], product[order]
    one = Level(key, zeros, ones, np.logaddexp(HALF + log_kt(zeros, ones), HALF + product), np.zeros(0, np.int64))
    zero = shorter(one)
    share1, rest1 = one.mixed(np.arange(len(key)))
    share0, rest0 = zero.mixed(zero.below)
    return Top(key, share0 + rest0 * share1, rest0 * rest1)


def gram_array(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(grams, counts of grams of each text): a gram for every byte and for the end of each text."""
    gap = bytes([END]) * depth
    joined = np.frombuffer(gap + b"".join(t + gap for t in texts), np.uint8)
    grams = np.zeros(len(joined) - depth, np.int64)
    for back in range(1, depth + 1):
        grams = grams << 8 | joined[depth - back : len(joined) - back]
    grams = grams << 8 | joined[depth:]
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    wanted = np.ones(len(grams), bool)
    ends = np.cumsum(sizes + depth - 1)
    for more in range(1, depth):
        wanted[ends - more] = False
    return grams[wanted], sizes


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z), and the token that ends the text."""
    return [*text.lower().split(), END_TOKEN]


PACKED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("learn", pa.bool_()), ("text", pa.binary())])


def packed(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, PACKED, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


def unpacked(pack: bytes) -> dict[str, list]:
    return pa.ipc.open_stream(pack).read_all().to_pydict()


def arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def block_table(docs: DataFrame, learn: Column, block_bytes: int) -> DataFrame:
    """(block, pack): the texts in blocks of some ``block_bytes`` of one task each, in compressed packs of up to some
    ``CUT`` bytes. It is written, so that a block stays what it is."""
    given = docs.select(
        F.spark_partition_id().cast("bigint").alias("part"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(learn, F.lit(False)).alias("learn"), F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = total = row = 0
        for batch in batches:
            begin = size = 0
            lengths = pc.binary_length(batch.column(3)).to_pylist()
            for at, length in enumerate(lengths, 1):
                size += length + 1
                if size >= min(CUT, block_bytes) or at == len(lengths):
                    numbers = pa.array(np.arange(row, row + at - begin))
                    part = batch.slice(begin, at - begin)
                    pack = packed(pa.RecordBatch.from_arrays([numbers, *part.columns[1:]], schema=PACKED))
                    block = part.column(0)[0].as_py() * (1 << 32) + number
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([pack], pa.binary())], ["block", "pack"])
                    row, begin, total, size = row + at - begin, at, total + size, 0
                    if total >= block_bytes:
                        number, total = number + 1, 0

    return written(given.mapInArrow(run, "block bigint, pack binary"), "blocks")


def asked_table(blocks: DataFrame, depth: int) -> DataFrame:
    """(block, gram, word, n): the distinct grams and tokens of each block, and how often texts to learn from have them."""
    schema = pa.schema([("block", pa.int64()), ("gram", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])

    def merged(found: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        grams, at = np.unique(np.concatenate(found), return_inverse=True)
        return [grams], [np.bincount(at, np.concatenate(numbers), len(grams)).astype(np.int64)]

    def counted(packs: Iterator[dict[str, list]]) -> Iterator[pa.RecordBatch]:
        found, numbers, words, waiting = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], {}, 0
        for pack in packs:
            for learn in (False, True):
                texts = [text for of, text in zip(pack["learn"], pack["text"], strict=True) if of == learn]
                if texts:
                    grams, n = np.unique(gram_array(texts, depth)[0], return_counts=True)
                    found.append(grams)
                    numbers.append(n * learn)
                    waiting += len(grams)
                for text in texts:
                    for word in tokens(text):
                        words[word] = words.get(word, 0) + learn
            if waiting > WAITING:
                (found, numbers), waiting = merged(found, numbers), 0
        [grams], [n] = merged(found, numbers)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(grams), pa.int64()), pa.array(grams), pa.nulls(len(grams), pa.binary()), pa.array(n)], schema=schema)
        listed = [pa.nulls(len(words), pa.int64()), pa.nulls(len(words), pa.int64()), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(listed, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((block.as_py(), pack) for batch in batches for block, pack in zip(*batch.columns, strict=True))
        for block, packs in itertools.groupby(rows, key=lambda r: r[0]):
            for found in counted(unpacked(pack.as_py()) for _, pack in packs):
                yield found.set_column(0, schema.field(0), pa.array(np.full(found.num_rows, block, np.int64)))

    return written(blocks.mapInArrow(run, ASKED), "asked", "zstd")


def gram_chances(counts: DataFrame, depth: int) -> DataFrame:
    """(gram, value): the logarithm of the chance of each gram's last byte after its others, from (gram, n).

    Contexts are dealt out by their last two bytes, with all that lie below; at most 256 ** (depth - 1) grams have
    these in common. Depths 0 and 1 have 255 nodes for each of at most 257 contexts and are mixed in one place.
    """
    dealt = counts.withColumn("tail", F.shiftrightunsigned("gram", 8 * (depth - 1)).cast("int"))
    nodes = "key bigint, zeros double, ones double, weighted double"
    names = [c.split()[0] for c in nodes.split(", ")]

    def whole(group: pa.Table) -> tuple[list[Level], np.ndarray, np.ndarray]:
        grams = group.column("gram").to_numpy()
        return *levels_of(grams, group.column("n").to_numpy(), depth, min(2, depth)), grams

    def ends(group: pa.Table) -> pa.Table:
        last = whole(group)[0][-1]
        return pa.table([last.key, last.zeros, last.ones, last.weighted], names)

    roots = dealt.groupBy("tail").applyInArrow(ends, nodes)
    up = F.shiftleft(F.shiftright("key", 16), 8).bitwiseOR(F.col("key").bitwiseAND(0xFF)).alias("key")
    ones = roots.groupBy(up).agg(*(F.sum(c).alias(c) for c in names[1:])).toArrow()
    top = top_of(*(ones.column(c).to_numpy() for c in names))

    def run(group: pa.Table) -> pa.Table:
        levels, node, grams = whole(group)
        keys = (levels[0].key >> (8 * depth) << 8) | levels[0].key & 0xFF  # the last byte of the context, and the place
        chance = top.mix(keys, ones_below(levels))
        return pa.table([grams, log_chance(node, grams & 0xFF, chance)], ["gram", "value"])

    return dealt.groupBy("tail").applyInArrow(run, "gram bigint, value double")


def scores(docs: DataFrame, learn: Column, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): its logarithms of probability under two models.

    The models learn from the rows where ``learn`` holds (null: not). ``base_score`` is that of the words, each by its
    count plus one; ``score`` that of the bytes of the whole text and its end by context-tree weighting, both to the
    base 10. Every bit of a byte, after those before it, has a tree of the contexts of up to ``depth`` bytes (2 to 6);
    every context mixes its Krichevsky-Trofimov estimate with what the contexts one byte longer make of it. Other
    columns: n_tokens, n_known, train_tokens, n_bytes, bits_per_byte (of the text and its end), block and row.

    Null texts count as empty: an end and nothing else. With nothing to learn from every bit has an even chance.
    Repeated rows and rows without an id are scored and counted one by one. Columns but the three are not read.

    A block of texts asks once for each of its distinct grams and words, so what is moved follows the vocabulary
    of blocks and not the words. Counts and chances of grams stay tables; a frequent word stands once for each block.
    A single text must fit in a task's memory.
    """
    blocks = block_table(docs, learn, block_bytes)
    asked = asked_table(blocks, depth)
    grams, words = asked.where("gram is not null"), asked.where("word is not null")
    chances = written(gram_chances(written(grams.groupBy("gram").agg(F.sum("n").alias("n")), "grams"), depth), "chances")
    known = written(words.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0"), "words")
    total = known.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    answers = grams.join(chances, "gram").select("block", "gram", F.lit(None).cast("binary").alias("word"), "value")
    told = words.join(known, "word").select("block", F.lit(None).cast("bigint"), "word", F.col("c").cast("double"))
    schema = pa.schema([
        ("block", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("n_bytes", pa.int64()), ("known_log", pa.float64()), ("score", pa.float64()),
    ])

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        part = told.filter(told.column("gram").is_valid())
        table = GramTable(part.column("gram").to_numpy(), part.column("value").to_numpy())
        part = told.filter(told.column("word").is_valid())
        logs = np.log10(part.column("value").to_numpy() + 1.0)
        of_word = dict(zip(part.column("word").to_pylist(), logs.tolist(), strict=True))
        found = []
        for block, packed_texts in zip(texts.column("block").to_pylist(), texts.column("pack"), strict=True):
            pack = unpacked(packed_texts.as_py())
            wanted, sizes = gram_array(pack["text"], depth)
            values = np.add.reduceat(table.find(wanted), np.cumsum(sizes) - sizes) / np.log(10)
            rows = zip(pack["row"], pack["doc_id"], pack["text"], sizes.tolist(), values.tolist(), strict=True)
            for row, doc_id, text, size, value in rows:
                words = tokens(text)
                hits = [of_word[w] for w in words if w in of_word]
                found.append((block, row, doc_id, len(words), len(hits), size - 1, sum(hits), value))
        return pa.Table.from_batches([arrow(found, schema)])

    both = blocks.groupBy("block").cogroup(answers.union(told).groupBy("block")).applyInArrow(run, SCORED)
    base = F.col("known_log") - F.col("n_tokens") * F.lit(float(np.log10(total.n + total.v + 1)))
    bits = -F.col("score") * F.lit(float(np.log2(10))) / (F.col("n_bytes") + 1)
    return both.select(
        "doc_id", "n_tokens", "n_known", F.lit(total.n).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score",
        "n_bytes", bits.alias("bits_per_byte"), "block", "row",
    )
