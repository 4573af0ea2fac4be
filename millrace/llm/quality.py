"""Quality classifier by co-training: words of the text on one side, the page's metadata and shape on the other.

For each head (low quality, toxic) two logistic models learn from the same labelled rows. Over a few rounds each
hands the other its most confident unlabelled rows as pseudo-labels, in the proportion of the labelled classes, but
only rows that the giver's calibrated probability puts beyond the confidence bound. The calibrated views are then
added as log-odds (less the prior, which both hold) with weights fitted on the calibration rows, and all documents are scored.
Of the rounds, the one counts that explains the calibration rows best, so an exchange that does harm is taken back.

Fitting uses bounded samples, of ``labelled`` and ``unlabelled`` rows, chosen by a hash of doc_id; a class that is rare
among the labels is drawn more often, and its odds corrected for that. Scoring covers every row and whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import give_back

LABELLED, UNLABELLED = 8000, 4000
WORD_BITS, META_BITS = 18, 10
#: A slot counts if so many rows of the fitting sample have it.
LEAST_ROWS = 3
ROUNDS, CONFIDENT = 3, 0.98
#: Share of the pool that a view may label for the other in a round, times the round's number.
EXCHANGED = 0.075
#: Labelled rows of a class that are drawn at least, if there are so many.
LEAST_OF_CLASS = 400
HEADS = ("low_quality", "toxic")
KEEP_AT = 0.5
#: Rows whose features a worker holds at once, in characters of text.
CHUNK_CHARS = 1_000_000
#: Words whose hash a worker remembers, some 200 bytes each, for as long as it lives.
REMEMBERED = 100_000
WORD = re.compile(r"[^\W_]+")


class Sparse(NamedTuple):
    """Rows of (index, value) pairs, one after another."""

    start: np.ndarray
    index: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
        sizes = [len(i) for i, _ in rows]
        join = lambda k, kind: np.concatenate([r[k] for r in rows]).astype(kind) if rows else np.zeros(0, kind)
        return cls(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), join(0, np.int32), join(1, np.float32))

    def __len__(self):
        return len(self.start) - 1

    def dot(self, w: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.value * w[self.index], dtype=np.float64)])
        return total[self.start[1:]] - total[self.start[:-1]]

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, weights=self.value * np.repeat(g, np.diff(self.start)), minlength=size)

    def take(self, rows: np.ndarray) -> Sparse:
        return Sparse.of([(self.index[self.start[i] : self.start[i + 1]], self.value[self.start[i] : self.start[i + 1]]) for i in rows])


_CRC: dict[str, int] = {}


def _slot(word: str, bits: int) -> int:
    found = _CRC.get(word)
    if found is None:
        if len(_CRC) > REMEMBERED:
            _CRC.clear()
        found = _CRC[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return found >> (32 - bits)


def text_view(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Which words, and which beginnings of words, the text has: each once, as a hashed slot, whatever its number; slot 0
    is the intercept. Beginnings speak for inflected and unseen words."""
    words = set(WORD.findall((text or "").lower()))
    words |= {f"{w[:4]}-" for w in words if len(w) > 4}
    slots = np.unique(np.fromiter((max(1, _slot(w, WORD_BITS)) for w in words), dtype=np.int64, count=len(words)))
    return np.concatenate([[0], slots]), np.ones(len(slots) + 1)


def meta_view(text: str | None, lang: str | None, source: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Source, language, size, lines and shares of character kinds, as slots of equal weight; slot 0 is the intercept."""
    text = text or ""
    n = len(text)
    lines = text.split("\n")
    words = text.split()
    letters = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text))
    share = lambda x, of: f"{min(20, int(20 * x / of))}" if of else "none"
    facts = {
        "lang": lang, "source": source, "size": n.bit_length(), "lines": len(lines).bit_length(), "line": (n // max(1, len(lines))).bit_length(),
        "letters": share(letters, n), "upper": share(upper, letters), "digits": share(sum(map(str.isdigit, text)), n),
        "marks": share(n - letters - sum(map(str.isspace, text)), n), "distinct": share(len(set(words)), len(words)),
        "lines distinct": share(len(set(lines)), len(lines)), "word": min(24, letters // max(1, len(words))),
    }
    slots = np.unique([max(1, _slot(f"{k}={v}", META_BITS)) for k, v in facts.items()])
    return np.concatenate([[0], slots]), np.ones(len(slots) + 1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: Sparse, y: np.ndarray, size: int, l2: float, steps: int = 150) -> np.ndarray:
    """Weights by full-batch AdaGrad; the same rows give the same weights.

    Slots are scaled by how much oftener one class has them than the other (naive-Bayes log ratios), so that the
    many words of a long text that tell nothing stay near zero.
    """
    one = Sparse(x.start, x.index, np.ones_like(x.value))
    has, hits = one.back(np.ones(len(y)), size), one.back(y, size)
    ratio = np.log((hits + 1) / (y.sum() + 2)) - np.log((has - hits + 1) / (len(y) - y.sum() + 2))
    ratio[has < LEAST_ROWS] = 0.0
    # words that chance alone can explain are shrunk away
    ratio *= np.clip(np.abs(hits - has * y.mean()) / np.sqrt(has * y.mean() * (1 - y.mean()) + 1e-9) - 2.0, 0.0, 4.0) / 4.0
    ratio[0] = 1.0
    x = Sparse(x.start, x.index, (x.value * ratio[x.index]).astype(np.float32))
    w, seen = np.zeros(size), np.full(size, 1e-8)
    for _ in range(steps):
        g = x.back((_sigmoid(x.dot(w)) - y) / len(y), size)
        g[1:] += l2 * w[1:]
        seen += g * g
        w -= 0.3 * g / np.sqrt(seen)
    return w * ratio


def fit_platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) so that sigmoid(a z + b) is a probability: Newton's steps on smoothed targets, a kept from turning negative."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(40):
        p = _sigmoid(a * z + b)
        d, r = p * (1 - p) + 1e-9, p - t
        h = np.array([[(d * z * z).sum() + 1e-6, (d * z).sum()], [(d * z).sum(), d.sum() + 1e-6]])
        step = np.linalg.solve(h, [(r * z).sum() + 1e-6 * a, r.sum()])
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
    return max(0.0, float(a)), float(b)


class Head(NamedTuple):
    """A view's weights and calibration, and the weights of the two views in the sum of log-odds."""

    text: np.ndarray
    meta: np.ndarray
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    prior: float
    final: tuple[float, float]

    def probability(self, text: Sparse, meta: Sparse) -> np.ndarray:
        (a, b), (c, d) = self.text_scale, self.meta_scale
        odds = (a * text.dot(self.text) + b) + (c * meta.dot(self.meta) + d) - self.prior
        return _sigmoid(self.final[0] * odds + self.final[1])


def co_train(views: tuple[Sparse, Sparse], y: np.ndarray, pool: tuple[Sparse, Sparse], rounds: int = ROUNDS) -> Head:
    """A head from labelled rows and a pool of unlabelled ones. Every fourth labelled row calibrates."""
    sizes, l2 = (1 << WORD_BITS, 1 << META_BITS), (1e-3, 1e-4)
    hold = np.arange(len(y)) % 4 == 3
    fit, cal = np.flatnonzero(~hold), np.flatnonzero(hold)
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    prior = float(np.log(share / (1 - share)))
    base = [v.take(fit) for v in views]
    check = [v.take(cal) for v in views]
    extra: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * 2  # what each view has been given
    best: tuple[float, Head] | None = None
    for turn in range(rounds + 1):
        weights, scales = [], []
        for k in (0, 1):
            given = pool[k].take(extra[k][0])
            x = Sparse(np.concatenate([base[k].start, base[k].start[-1] + given.start[1:]]), np.concatenate([base[k].index, given.index]), np.concatenate([base[k].value, given.value]))
            weights.append(fit_logistic(x, np.concatenate([y[fit], extra[k][1]]), sizes[k], l2[k]))
            scales.append(fit_platt(check[k].dot(weights[k]), y[cal]))
        head = Head(*weights, *scales, prior, (1.0, 0.0))
        p = np.clip(head.probability(*check), 1e-9, 1 - 1e-9)
        head = head._replace(final=fit_platt(np.log(p / (1 - p)), y[cal]))
        p = np.clip(head.probability(*check), 1e-9, 1 - 1e-9)
        loss = float(-np.mean(np.where(y[cal] > 0, np.log(p), np.log(1 - p)))) if len(cal) else 0.0
        if best is None or loss < best[0]:
            best = (loss, head)
        if turn == rounds or not len(pool[0]):
            break
        for k in (0, 1):
            p = _sigmoid(scales[k][0] * pool[k].dot(weights[k]) + scales[k][1])
            order, most = np.argsort(p, kind="stable"), int(EXCHANGED * (turn + 1) * len(p))
            yes = [i for i in order[::-1][: max(1, int(most * share))] if p[i] >= CONFIDENT]
            no = [i for i in order[: most - int(most * share)] if p[i] <= 1 - CONFIDENT]
            extra[1 - k] = (np.array(yes + no, dtype=np.int64), np.array([1.0] * len(yes) + [0.0] * len(no)))
    return best[1]


def _features(docs: DataFrame) -> DataFrame:
    """docs' other columns with both views as bytes."""

    def view(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = list(zip(batch["text"], batch["lang"], batch["source"]))
            for name, made in (("tv", [text_view(t) for t, _, _ in rows]), ("mv", [meta_view(*r) for r in rows])):
                batch[name] = [np.concatenate([i.astype("<f4"), v.astype("<f4")]).tobytes() for i, v in made]
            yield batch.drop(columns=["text", "lang", "source"])
        give_back()

    others = [f for f in docs.schema.fields if f.name not in ("text", "lang", "source")]
    return docs.mapInPandas(view, ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in others] + ["tv binary", "mv binary"]))


def _unpack(raw: list[bytes]) -> Sparse:
    rows = [np.frombuffer(r, dtype="<f4") for r in raw]
    return Sparse.of([(r[: len(r) // 2], r[len(r) // 2 :]) for r in rows])


def _share(column: str, seed: int):
    return F.pmod(F.xxhash64(F.col(column).cast("string"), F.lit(seed)), F.lit(1_000_003)) / 1_000_003.0


def _with_meta(docs: DataFrame) -> DataFrame:
    text = lambda c: (F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")).alias(c)
    return docs.select("doc_id", text("text"), text("lang"), text("source"))


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED, rounds: int = ROUNDS) -> dict[str, Head]:
    """A head for each target that the sampled labels hold both classes of; labels has doc_id, quality and toxic.

    Labels with a null doc_id, quality and toxic, or without a document, teach nothing; a null target teaches its head
    nothing. A doc_id with several labels takes the worst.
    """
    marks = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy("doc_id").agg(F.max((F.col("quality") == 0).cast("int")).alias("low_quality"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    n_docs = docs.count()
    kind = F.concat_ws(",", *(F.coalesce(F.col(h).cast("string"), F.lit("-")) for h in HEADS))
    counts = {r["kind"]: r["n"] for r in marks.groupBy(kind.alias("kind")).agg(F.count("*").alias("n")).collect()}  # at most nine kinds
    if not counts:
        return {}
    rate = labelled / sum(counts.values())
    rates = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, max(rate, LEAST_OF_CLASS / n)))))

    def drawn(share) -> DataFrame:
        """Documents of a share of the ids, one for each id; the rest is left before anything is shuffled."""
        return _with_meta(docs).where("doc_id IS NOT NULL").where(share).dropDuplicates(["doc_id"])

    if rate >= 1 or all(rate >= LEAST_OF_CLASS / n for n in counts.values()):
        chosen = drawn(_share("doc_id", 7) < rate).join(marks, "doc_id")
    else:  # the labels say which documents are of a rare class
        wanted = marks.where(_share("doc_id", 7) < rates[kind])
        chosen = _with_meta(docs).where("doc_id IS NOT NULL").join(wanted, "doc_id").dropDuplicates(["doc_id"])
    rows = _features(chosen).toPandas().sort_values("doc_id")  # about `labelled` rows, and LEAST_OF_CLASS of each rare kind
    if not len(rows):
        return {}
    pool_rate = unlabelled / max(1, n_docs)
    pool = drawn(_share("doc_id", 8) < pool_rate).join(marks.select("doc_id"), "doc_id", "left_anti")
    spare = _features(pool).toPandas().sort_values("doc_id")  # about `unlabelled` rows
    more = tuple(_unpack(spare[c].tolist()) for c in ("tv", "mv"))
    heads = {}
    for place, h in enumerate(HEADS):
        known = rows[rows[h].notna()]
        y = known[h].to_numpy(dtype=np.float64)
        if 0 < y.sum() < len(y):
            head = co_train(tuple(_unpack(known[c].tolist()) for c in ("tv", "mv")), y, more, rounds)
            # odds among all labels, less the odds in the sample that was fitted
            all_of = {v: sum(n for k, n in counts.items() if k.split(",")[place] == v) for v in "01"}
            shift = np.log((all_of["1"] + 0.5) / (all_of["0"] + 0.5)) - np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
            heads[h] = head._replace(final=(head.final[0], head.final[1] + float(shift)))
    return heads


def score(docs: DataFrame, heads: dict[str, Head]) -> DataFrame:
    """docs with p_low_quality, p_toxic, quality_score and accepted (score of at least one half).

    The score is the chance of neither fault. A head that could not be trained finds no fault. Null and empty texts
    are scored by their metadata and have no words. Repeated rows get equal scores. Columns of docs with one of the
    four names are replaced; others stay; a missing lang or source counts as null.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(heads)

    @F.pandas_udf("struct<p_low_quality:double,p_toxic:double>")
    def judge(text: pd.Series, lang: pd.Series, source: pd.Series) -> pd.DataFrame:
        rows, parts, at = list(zip(text, lang, source)), [], 0
        while at < len(rows):
            to, size = at, 0
            while to < len(rows) and size < CHUNK_CHARS:
                size += len(rows[to][0] or "")
                to += 1
            words, meta = Sparse.of([text_view(t) for t, _, _ in rows[at:to]]), Sparse.of([meta_view(*r) for r in rows[at:to]])
            parts.append(np.stack([shipped.value[h].probability(words, meta) if h in shipped.value else np.zeros(to - at) for h in HEADS], axis=1))
            at = to
        give_back()
        return pd.DataFrame(np.concatenate(parts) if parts else np.zeros((0, 2)), columns=["p_low_quality", "p_toxic"])

    made = ("p_low_quality", "p_toxic", "quality_score", "accepted")
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]
    view = [F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string") for c in ("text", "lang", "source")]
    out = docs.select(*keep, judge(*view).alias("__q")).select(*keep, F.col("__q.p_low_quality").alias("p_low_quality"), F.col("__q.p_toxic").alias("p_toxic"))
    return out.withColumn("quality_score", (1 - F.col("p_low_quality")) * (1 - F.col("p_toxic"))).withColumn("accepted", F.col("quality_score") >= KEEP_AT)
