"""Benchmark decontamination by winnowing, in DataFrame functions only.

A passage counts as leaked when ten consecutive words of an item stand in a document (all words of an item that has
fewer). Winnowing keeps, of every six neighbouring 5-gram hashes, the smallest, so documents and items that share
ten words share a kept fingerprint: ten words hold six 5-grams, and both sides choose the same of them. The join of
fingerprints gives the places in a document from which a hit may extend: each of the six windows that hold the
place is then looked up by its words among the items' distinct windows, so hash collisions never count, and a text that
repeats itself costs its length, not its square.

Items of fewer than ten words have no full window; they are looked up by the hash of as many words as they have.
Texts are shuffled only if very many documents have a fingerprint of an item; else they stay where they are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import Stash

WINDOW, GRAM = 10, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What is broadcast: up to so many fingerprints (24 bytes each), up to four times as many longs in all of the documents' keys and
#: places that hold one, and up to so many characters of the items' windows. Larger tables meet the documents in a shuffled join.
BROADCAST_FINGERPRINTS = 400_000
BROADCAST_CHARS = 32_000_000
#: Word hashes stay below this prime and factors below 2**28, so a sum of nine products fits in a long.
PRIME = 2_147_483_629
FACTORS = (137_938_155, 195_760_493, 226_556_657, 208_066_001, 199_667_585, 255_822_877, 152_444_639, 173_776_101, 215_426_177)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body with value computed once: an expression that a lambda mentions is otherwise computed at every call."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of the whole text: runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. Null: none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NO_WORD), "")


def word_numbers(words: Column) -> Column:
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME)))


def gram_hashes(numbers: Column, k: int) -> Column:
    """Hash of the k words at each place."""
    n = F.size(numbers)

    def at(i: Column) -> Column:
        total = F.get(numbers, i) * F.lit(FACTORS[0])
        for j in range(1, k):
            total = total + F.get(numbers, i + j) * F.lit(FACTORS[j])
        return F.xxhash64(total)

    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), at)).otherwise(F.array().cast("array<bigint>"))


def kept_places(grams: Column) -> Column:
    """Places of the winnowed grams: those that are smallest in some run of six (of all, if there are fewer)."""
    size = WINDOW - GRAM + 1
    n = F.size(grams)
    lows = F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), lambda i: F.least(*(F.get(grams, i + j) for j in range(size)))))
    by_run = let(lows, lambda m: F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.greatest(*(F.get(m, i - j) for j in range(size))) == F.get(grams, i)))
    all_of_few = let(F.array_min(grams), lambda low: F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(grams, i) == low))
    return F.when(n >= size, by_run).when(n > 0, all_of_few).otherwise(F.array().cast("array<int>"))


def _marks(words: Column, short: list[int], winnow: bool = True, total: bool = False) -> Column:
    """Array of (k, hash, pos): winnowed 5-grams as k = 0, and all k-grams for the lengths of short items; with total, also
    the number of words as the pos of TOTAL."""

    def whole(numbers: Column, k: int) -> Column:
        return F.transform(gram_hashes(numbers, k), lambda g, i: F.struct(F.lit(k).alias("k"), g.alias("hash"), i.alias("pos")))

    def of(numbers: Column) -> Column:
        parts = [let(gram_hashes(numbers, GRAM), lambda g: F.transform(kept_places(g), lambda i: F.struct(F.lit(0).alias("k"), F.get(g, i).alias("hash"), i.alias("pos"))))] if winnow else []
        if total:
            parts.append(F.array(F.struct(F.lit(TOTAL).alias("k"), F.lit(0).cast("long").alias("hash"), F.size(numbers).alias("pos"))))
        return F.concat(*parts, *(whole(numbers, k) for k in short))

    return let(word_numbers(words), of)


def _exploded(df: DataFrame, keep: list[str], words: Column, short: list[int], winnow: bool = True, total: bool = False) -> DataFrame:
    return df.select(*keep, F.explode(_marks(words, short, winnow, total)).alias("__x")).select(*keep, "__x.k", "__x.hash", "__x.pos")


KEY = ["__id", "__h", "__g"]
#: Mark that every document has, with its number of words.
TOTAL = -1


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with a key: rows of one doc_id are told apart by two hashes of their texts."""
    return docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("__h"), F.xxhash64(F.lit(1), F.coalesce("text", F.lit(""))).alias("__g"))


def _join(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """By key; a null doc_id is one of its own."""
    named = right.select(*(F.col(c).alias(f"{c}_r") for c in KEY), *(c for c in right.columns if c not in KEY))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_r")) for c in KEY]
    return left.join(named, same[0] & same[1] & same[2], how).drop(*(f"{c}_r" for c in KEY))


def _packed(high: Column, low: Column) -> Column:
    """Two numbers as one long, which sets and sorts handle faster than a struct."""
    return F.shiftleft(high.cast("long"), 32) + low.cast("long")


def _high(packed: Column) -> Column:
    return F.shiftright(packed, 32).cast("int")


def _low(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def window_at(words: Column, start: Column, k: Column) -> Column:
    """The k words from a place; no word holds a space."""
    return F.array_join(F.slice(words, start + 1, k), " ")


def item_windows(items: DataFrame) -> DataFrame:
    """(k, win, items): each distinct window of k words, and the ids of the items that have it."""
    k = F.least(F.lit(WINDOW), F.size("__w"))
    each = items.select("item_id", k.alias("k"), F.explode(F.transform(F.sequence(F.lit(0), F.size("__w") - k), lambda i: window_at(F.col("__w"), i, k))).alias("win"))
    return each.groupBy("k", "win").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def leaks(docs: DataFrame, benchmark: DataFrame, stash: Stash, total: bool = False) -> tuple[DataFrame, DataFrame]:
    """Key, packed spans and item ids of the documents with a hit; and the key, words and rows of those with a fingerprint of an
    item, with ``total`` of all. docs are as _keyed() gives them."""
    texts = docs
    items = stash.keep(benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("__w")).where("size(__w) > 0").distinct(), "items")
    short = sorted(r[0] for r in items.where(F.size("__w") < WINDOW).select(F.size("__w")).distinct().collect())  # at most nine lengths
    marks = _exploded(items.where(F.size("__w") >= WINDOW), [], F.col("__w"), []).select("k", "hash")
    if short:
        few = items.where(F.size("__w") < WINDOW).select(F.size("__w").alias("__n"), "__w")
        marks = marks.union(_exploded(few, ["__n"], F.col("__w"), short, winnow=False).where("k = __n").select("k", "hash"))
    # One row per fingerprint: a gram that many items share then meets each document position once.
    if total:
        marks = marks.union(marks.sparkSession.createDataFrame([(TOTAL, 0)], "k int, hash long"))
    known = stash.keep(marks.distinct(), "fingerprints")
    if known.count() <= BROADCAST_FINGERPRINTS:
        known = F.broadcast(known)
    windows = stash.keep(item_windows(items), "windows")
    if (windows.agg(F.sum(F.length("win") + F.size("items") * 16)).head()[0] or 0) <= BROADCAST_CHARS and BROADCAST_FINGERPRINTS:
        windows = F.broadcast(windows)

    found = _exploded(texts, KEY, words_of(F.col("__text")), short, total=total).join(known, ["k", "hash"], "left_semi")
    place = F.when(F.col("k") != TOTAL, _packed(F.col("k"), F.col("pos")))
    judged = found.groupBy(*KEY).agg(F.max(F.when(F.col("k") == TOTAL, F.col("pos"))).alias("n_words"), F.count(F.when(F.col("k") == TOTAL, F.lit(1))).alias("rows"), F.collect_set(place).alias("__met"))
    judged = stash.keep(judged, "judged")
    met = judged.where(F.size("__met") > 0).select(*KEY, "__met")
    longs = met.agg(F.sum(F.size("__met") + 5)).head()[0] or 0
    places = F.broadcast(met) if longs <= 4 * BROADCAST_FINGERPRINTS else met

    def starts(words: Column) -> Column:
        """Packed (k, start) of all windows that hold a met fingerprint."""
        last = F.size(words) - WINDOW
        around = lambda m: F.transform(F.sequence(F.greatest(F.lit(0), _low(m) - (WINDOW - GRAM)), _low(m)), lambda i: _packed(F.lit(WINDOW), i))
        every = F.array_distinct(F.flatten(F.transform("__met", lambda m: F.when(_high(m) == 0, around(m)).otherwise(F.array(m)))))
        return F.filter(every, lambda x: (_high(x) < WINDOW) | (_low(x) <= last))

    one = let(words_of(F.col("__text")), lambda w: F.transform(starts(w), lambda x: F.struct(_high(x).alias("k"), _low(x).alias("start"), window_at(w, _low(x), _high(x)).alias("win"))))
    near = _join(texts, places, "inner").select(*KEY, F.explode(one).alias("__x")).select(*KEY, "__x.*")
    hits = near.join(windows, ["k", "win"]).groupBy(*KEY).agg(F.array_sort(F.collect_set(_packed(F.col("start"), F.col("start") + F.col("k") - 1))).alias("__spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("__items"))
    return hits, judged.select(*KEY, "n_words", "rows")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans, n_items, items_sha256 and contaminated for every row of docs.

    n_hit counts the document's words inside any occurrence of a window of any item, each word once; spans are the windows'
    first and last words; items are the ids of items with an occurring window, as strings in order. Null and empty texts
    have no words and no hits. Rows that repeat a doc_id, or have a null one, are each judged by their own text. Items with
    null ids or equal texts count by id; an item with a null id makes hits but is not listed. Empty tables are allowed on
    either side. Other columns are ignored.
    """
    stash = Stash(docs.sparkSession, "decontam")
    hits, judged = leaks(_keyed(docs), benchmark, stash, total=True)
    judged = stash.keep(_join(judged, hits, "left"), "hits")
    stash.drop_others(judged)
    judged = judged.withColumn("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))  # rows that repeat id and text
    # Each word counts for the span that reaches it first: spans in order, each from where the ones before end.
    covered = F.aggregate(
        "__spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), _low(s) - F.greatest(_high(s) - 1, acc["end"]))).alias("n"), F.greatest(acc["end"], _low(s)).alias("end")),
        lambda acc: acc["n"],
    )
    return (
        judged.withColumns({"__spans": F.coalesce("__spans", F.array().cast("array<bigint>")), "__items": F.coalesce("__items", F.array().cast("array<string>"))})
        .select(F.col("__id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"), covered.alias("n_hit"), F.col("__items").alias("items"), F.transform("__spans", lambda s: F.struct(_high(s).alias("first"), _low(s).alias("last"))).alias("spans"))
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("items", ",").cast("binary"), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose text holds no window of an item, in all their columns, whatever their doc_id."""
    stash = Stash(docs.sparkSession, "decontam")
    dirty = stash.keep(leaks(_keyed(docs), benchmark, stash)[0].select("__h", "__g").distinct(), "dirty")
    stash.drop_others(dirty)
    dirty = F.broadcast(dirty) if dirty.count() <= BROADCAST_FINGERPRINTS else dirty
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.join(dirty, (F.xxhash64(text) == F.col("__h")) & (F.xxhash64(F.lit(1), text) == F.col("__g")), "left_anti")
