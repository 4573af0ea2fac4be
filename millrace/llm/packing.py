"""Best-fit packing by exact-complement hashing.

What decides a packing is how many pieces there are of each length, a histogram of at most ``capacity`` counts
whatever the corpus size. The driver solves that: for the gap left in a sequence it looks up single, pair and
triple sums of lengths that still have pieces and fill the gap exactly, and repeats the pattern as often as the
counts allow; what can't be filled exactly is packed best-fit decreasing. The executors then deal the pieces of
each length, by their rank, to the slots of the patterns.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.storage import BATCH, Stash, give_back
from millrace.llm.tokenize import encoder, pieces_of

CAPACITY, EOS = 1024, 2
PIECES = "piece int, start long, length long, ids_crc32 long"


class SumIndex:
    """Hash tables from a sum to the single, pair and triple combinations of lengths that make it, under availability counts.

    ``pairs[s]`` holds the larger members of pairs, ``triples[s]`` the largest members of triples whose other two are a
    pair of the table, both largest first. Counts only fall, so each table's cursor passes a used-up combination once
    and never comes back to it. The tables have about capacity squared entries at most, whatever the corpus size.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = [0] * (capacity + 1)
        for length, n in counts.items():
            self.left[length] = n
        self.top = capacity
        lengths = np.array(sorted((k for k, n in counts.items() if n > 0), reverse=True), dtype=np.int64)
        a, b = (x.ravel() for x in np.meshgrid(lengths, lengths, indexing="ij"))
        fits = (a >= b) & (a + b <= capacity)
        self.pairs = self._table(a[fits] + b[fits], a[fits])
        # the smallest larger member of each pair sum: a triple exists if it is no longer than the third
        low = {s: members[-1] for s, members in self.pairs.items()}
        sums, least = (np.array(x, dtype=np.int64) for x in (list(low), list(low.values())))
        a, s = (x.ravel() for x in np.meshgrid(lengths, sums, indexing="ij"))
        fits = (a >= np.tile(least, len(lengths))) & (a + s <= capacity)
        self.triples = self._table(a[fits] + s[fits], a[fits])
        self.at_pair, self.at_triple = Counter(), Counter()

    @staticmethod
    def _table(sums: np.ndarray, members: np.ndarray) -> dict[int, list[int]]:
        order = np.lexsort((-members, sums))
        sums, members = sums[order], members[order]
        keys, first = np.unique(sums, return_index=True)
        return {int(k): part.tolist() for k, part in zip(keys, np.split(members, first[1:]))}

    def largest(self, limit: int, used: Counter) -> int:
        while self.top and not self.left[self.top]:
            self.top -= 1
        a = min(limit, self.top)
        while a > 0 and self.left[a] - used[a] <= 0:
            a -= 1
        return a

    def single(self, gap: int, used: Counter) -> tuple[int, ...]:
        return (gap,) if self.left[gap] - used[gap] > 0 else ()

    def _has_pair(self, gap: int, a: int, used: Counter | dict) -> bool:
        b = gap - a
        return self.left[a] - used.get(a, 0) > (a == b) and self.left[b] - used.get(b, 0) > 0

    def pair(self, gap: int, used: Counter, most: int | None = None) -> tuple[int, ...]:
        """Largest member first, at most ``most``."""
        members, at = self.pairs.get(gap, ()), self.at_pair[gap]
        while at < len(members) and not self._has_pair(gap, members[at], {}):
            at += 1
        self.at_pair[gap] = at
        for a in members[at:]:
            if (most is None or a <= most) and self._has_pair(gap, a, used):
                return (a, gap - a)
        return ()

    def triple(self, gap: int, used: Counter) -> tuple[int, ...]:
        members, at = self.triples.get(gap, ()), self.at_triple[gap]
        while at < len(members) and not (self.left[members[at]] and self.pair(gap - members[at], Counter())):
            at += 1
        self.at_triple[gap] = at
        for a in members[at:]:
            if self.left[a] - used[a] > 0:
                if rest := self.pair(gap - a, used + Counter({a: 1}), most=a):
                    return (a, *rest)
        return ()


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Patterns as (how many sequences, {length: pieces in each}); together they use every piece once.

    A pattern starts with the longest length left. The gap is filled exactly by one, two or three lengths where the
    index has such a sum; otherwise the longest that fits goes in, and the search repeats for what remains.
    """
    index, patterns = SumIndex(counts, capacity), []
    while start := index.largest(capacity, Counter()):
        used, gap = Counter({start: 1}), capacity - start
        while gap:
            exact = index.single(gap, used) or index.pair(gap, used) or index.triple(gap, used)
            take = exact or ((a,) if (a := index.largest(gap, used)) else ())
            if not take:
                break
            used.update(take)
            gap -= sum(take)
        times = min(index.left[a] // n for a, n in used.items())
        for a, n in used.items():
            index.left[a] -= times * n
        patterns.append((times, dict(used)))
    return patterns


def slot_table(patterns: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: runs of ranks, sorted by length and first rank.

    There are at most a few runs per pattern, and each pattern uses up a length, so the table does not grow with
    the corpus.
    """
    ranks: Counter = Counter()
    rows, sequence = [], 0
    for times, used in patterns:
        at = 0
        for length in sorted(used, reverse=True):
            rows.append((length, ranks[length], sequence, used[length], at))
            ranks[length] += times * used[length]
            at += length * used[length]
        sequence += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "each", "at"), cols.T))


def place(table: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence_id, offset) of the pieces with these lengths and ranks."""
    run = np.empty(len(length), dtype=np.int64)
    for value in np.unique(length):
        lo, hi = np.searchsorted(table["length"], [value, value + 1])
        at = length == value
        run[at] = lo + np.searchsorted(table["rank"][lo:hi], rank[at], side="right") - 1
    within = rank - table["rank"][run]
    each = table["each"][run]
    return table["sequence"][run] + within // each, table["at"][run] + within % each * length


def tokenize_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, eos: int = EOS) -> DataFrame:
    """A row per piece: doc_id, piece, start, length and the CRC-32 of its little-endian 32-bit ids."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text or "")
                ids.append(eos)
                raw = memoryview(ids).cast("B")
                for k, (start, length) in enumerate(pieces_of(len(ids), capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    # ids travel as text: beside a null, pandas would hold whole numbers as floating ones
    cut_docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(cut, f"doc_id string, {PIECES}")
    return cut_docs.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, eos: int = EOS) -> DataFrame:
    """Pieces of all documents with their sequence_id and gapless offset.

    Null and empty texts are documents of the end token alone. Longer documents than the capacity are cut, the
    shorter piece first. Repeated rows are packed as often as they occur; a null doc_id stays null. Other columns of
    docs are ignored. An empty table gives an empty result. doc_id may be any integer or string type.
    """
    spark = docs.sparkSession
    stash = Stash(spark, "pack")
    pieces = stash.keep(tokenize_pieces(docs, tokenizer, capacity, eos), "pieces", BATCH)
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    table = spark.sparkContext.broadcast(slot_table(solve(counts, capacity)))

    # Rank of each piece among those of its length, without bringing a length into one task: rank within salted parts,
    # then add the sizes of the parts before.
    parts = 16 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(counts.values()) // 800_000 + 1)
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    before = (
        salted.groupBy("length", "__salt").agg(F.count("*").alias("n"))
        .select("length", "__salt", (F.sum("n").over(Window.partitionBy("length").orderBy("__salt")) - F.col("n")).alias("__before"))
    )
    order = [F.col(c) for c in ("doc_id", "piece", "start", "ids_crc32")]
    ranked = (
        salted.withColumn("__rank", F.row_number().over(Window.partitionBy("length", "__salt").orderBy(*order)) - 1)
        .join(before, ["length", "__salt"])
        .withColumn("__rank", F.col("__rank") + F.col("__before"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "__rank")
    )

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["sequence_id"], batch["offset"] = place(table.value, batch["length"].to_numpy(), batch.pop("__rank").to_numpy())
            yield batch

    dealt = ranked.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(deal, f"doc_id string, {PIECES}, sequence_id long, offset long")
    return dealt.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
