"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A trigram's vector binds (multiplies) its letters' vectors,
rotated by their place; a text's vector bundles (adds) its trigrams; a language's prototype bundles its texts. A text
belongs to the language whose prototype has the largest cosine to it.

Texts are bundled a few at a time, as a product of their trigram counts with the vectors of the trigrams they have, of
which each worker keeps a table of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import give_back

DIMENSION = 2048
#: Documents a language learns from, about: chosen by a hash of doc_id, at a rate set from the language's count.
SAMPLE_PER_LANGUAGE = 4000
#: Characters and texts handled at once, and rows of a worker's tables of trigrams and letters before they start afresh.
CHUNK_CHARS, TOGETHER, TABLE_ROWS, LETTERS = 1_000_000, 16, 40_000, 20_000
#: Steepness of the softmax over cosines that gives the score.
STEEPNESS = 24.0
UNDETERMINED = "und"


class Letters:
    """Code points folded to lower-case letters, everything else to one space."""

    def __init__(self):
        self.fold = np.zeros(0x110000, dtype=np.int32)

    def __call__(self, text: str) -> np.ndarray:
        """The text's symbols with a space at either end and no two spaces in a row; one symbol if it has no letter."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        out = self.fold[codes]
        if not out.all():
            for c in np.unique(codes[out == 0]):
                low = chr(c).lower()
                self.fold[c] = ord(low[0]) if chr(c).isalpha() else 32
            out = self.fold[codes]
        out = np.concatenate([[32], out, [32]])
        return out[np.concatenate([[True], (out[1:] != 32) | (out[:-1] != 32)])]


def trigrams(symbols: np.ndarray) -> np.ndarray:
    s = symbols.astype(np.int64)
    return (s[:-2] << 42) | (s[1:-1] << 21) | s[2:]


class Vectors:
    """Letters' random vectors, from the code point alone, so that all workers agree."""

    def __init__(self, dimension: int):
        self.dimension, self.known = dimension, {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.known:
            if len(self.known) >= LETTERS:
                self.known.clear()
            self.known[code] = (np.random.default_rng([20_240_502, code]).integers(0, 2, self.dimension) * 2 - 1).astype(np.int8)
        return self.known[code]

    def grams(self, ids: np.ndarray) -> np.ndarray:
        """A row for each trigram: first letter rotated twice, second once, bound by multiplication."""
        parts = []
        for place, shift in ((42, 2), (21, 1), (0, 0)):
            codes, at = np.unique((ids >> place) & 0x1FFFFF, return_inverse=True)
            parts.append(np.stack([np.roll(self.letter(int(c)), shift) for c in codes])[at])
        return parts[0] * parts[1] * parts[2]


class Profiles(NamedTuple):
    langs: list[str]
    prototypes: np.ndarray  # unit rows, float32


class Table:
    """Vectors of trigrams, computed when first met and kept as a bit a component: set for +1."""

    def __init__(self, dimension: int):
        self.vectors = Vectors(dimension)
        self._clear()

    def _clear(self):
        self.ids, self.rows = np.zeros(0, dtype=np.int64), np.zeros((0, -(-self.vectors.dimension // 8)), dtype=np.uint8)
        self.at: np.ndarray = np.zeros(0, dtype=np.int64)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        """Bits of sorted distinct ids."""
        new = np.setdiff1d(ids, self.ids, assume_unique=True)
        if len(new):
            if len(self.ids) + len(new) > TABLE_ROWS:
                self._clear()
                new = ids
            merged = np.concatenate([self.ids, new])
            order = np.argsort(merged)
            self.rows = np.concatenate([self.rows, *(np.packbits(self.vectors.grams(new[i : i + 2000]) > 0, axis=1) for i in range(0, len(new), 2000))])
            self.ids, self.at = merged[order], np.concatenate([self.at, np.arange(len(self.rows) - len(new), len(self.rows))])[order]
        return np.unpackbits(self.rows[self.at[np.searchsorted(self.ids, ids)]], axis=1, count=self.vectors.dimension)


def cosines(ids: np.ndarray, texts: list[tuple[np.ndarray, np.ndarray]], table: Table, prototypes: np.ndarray) -> np.ndarray:
    """Cosine of each text's bundle with each prototype; 0 for a text without trigrams. ids are the texts' distinct trigrams."""
    out = np.zeros((len(texts), len(prototypes)))
    for at in range(0, len(texts), TOGETHER):
        part = texts[at : at + TOGETHER]
        used = np.unique(np.concatenate([i for i, _ in part]))
        counts = np.zeros((len(part), len(used)), dtype=np.float32)
        for row, (i, n) in zip(counts, part):
            row[np.searchsorted(used, i)] = n
        bundles = np.zeros((len(part), prototypes.shape[1]), dtype=np.float64)
        for a in range(0, len(used), 4000):  # a text of very many different trigrams
            bundles += 2 * (counts[:, a : a + 4000] @ table(ids[used[a : a + 4000]]).astype(np.float32)) - counts[:, a : a + 4000].sum(axis=1, keepdims=True)
        length = np.linalg.norm(bundles, axis=1, keepdims=True)
        out[at : at + TOGETHER] = np.divide(bundles @ prototypes.T, length, out=np.zeros((len(part), len(prototypes))), where=length > 0)
    return out


def chunks(texts: list[str | None]) -> Iterator[list[str]]:
    out, size = [], 0
    for t in texts:
        out.append(t or "")
        size += len(out[-1])
        if size > CHUNK_CHARS:
            yield out
            out, size = [], 0
    if out:
        yield out


def _bundled(texts: list[str], letters: Letters) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each chunk: its distinct trigrams, and each text's (indices, counts)."""
    for part in chunks(texts):
        grams = [trigrams(letters(t)) for t in part]
        ids, at = np.unique(np.concatenate(grams), return_inverse=True)
        cuts = np.cumsum([0, *map(len, grams)])
        yield ids, [np.unique(at[a:b], return_counts=True) for a, b in zip(cuts[:-1], cuts[1:])]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, lang: str = "lang", dimension: int = DIMENSION, sample: int = SAMPLE_PER_LANGUAGE) -> Profiles:
    """Prototypes from doc_id, text and lang. A language counts all its labelled rows, learns from about ``sample`` of them,
    and is known if one of these has a letter."""
    labelled = docs.select("doc_id", "text", F.col(lang).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not counts:
        return Profiles([], np.zeros((0, dimension), dtype=np.float32))
    rates = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, sample / n))))
    share = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(4)), F.lit(1_000_003)) / 1_000_003.0
    tasks = min(64, 4 + 2 * len(counts))  # each returns a vector for each language
    chosen = labelled.where(share < rates[F.col("lang")]).repartition(tasks, "doc_id")

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, vectors, sums = Letters(), Vectors(dimension), {}
        for batch in batches:
            for name, texts in batch.groupby("lang")["text"]:
                for ids, texts_grams in _bundled(texts.tolist(), letters):
                    weight = np.zeros(len(ids))
                    for at, n in texts_grams:
                        if len(at):
                            weight[at] += n / np.sqrt(np.square(n, dtype=np.float64).sum())
                    total = sums.setdefault(name, np.zeros(dimension))
                    for i in range(0, len(ids), 2000):
                        total += weight[i : i + 2000] @ vectors.grams(ids[i : i + 2000]).astype(np.float32)
        yield pd.DataFrame({"lang": list(sums), "total": [v.tobytes() for v in sums.values()]}).astype({"lang": "object"})

    totals: dict[str, np.ndarray] = {}
    for r in chosen.mapInPandas(bundle, "lang string, total binary").collect():  # a vector for each language and task
        totals[r["lang"]] = totals.get(r["lang"], 0) + np.frombuffer(r["total"])
    totals = {k: v for k, v in sorted(totals.items()) if v.any()}
    rows = [v / np.linalg.norm(v) for v in totals.values()]
    return Profiles(list(totals), np.array(rows, dtype=np.float32).reshape(-1, dimension))


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """docs with lang_pred, score and cosine.

    Texts that are null or have no letter are ``und`` with score and cosine 0, as is every text if no language is known.
    cosine is that of the text's bundle with the best prototype, and score its softmax share; ties go to the first language
    in order of name. Repeated rows get equal answers. Columns of docs named like these three are replaced; others stay.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(profiles)
    state: dict = {}

    @F.pandas_udf("struct<lang_pred:string,score:double,cosine:double>")
    def predict(text: pd.Series) -> pd.DataFrame:
        langs, prototypes = shipped.value.langs, shipped.value.prototypes.astype(np.float64)
        if not state:
            state["table"], state["letters"] = Table(prototypes.shape[1]), Letters()
        out = []
        for ids, texts in _bundled(text.tolist(), state["letters"]):
            if not langs:
                out += [(UNDETERMINED, 0.0, 0.0)] * len(texts)
                continue
            for (at, _), cosine in zip(texts, cosines(ids, texts, state["table"], prototypes)):
                if not len(at):
                    out.append((UNDETERMINED, 0.0, 0.0))
                    continue
                best = int(cosine.argmax())
                share = np.exp(STEEPNESS * (cosine - cosine[best]))
                out.append((langs[best], float(1.0 / share.sum()), float(cosine[best])))
        give_back()
        return pd.DataFrame(out, columns=["lang_pred", "score", "cosine"])

    made = ("lang_pred", "score", "cosine")
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]
    return docs.select(*keep, predict(F.col("text")).alias("__p")).select(*keep, *(F.col(f"__p.{c}").alias(c) for c in made))
