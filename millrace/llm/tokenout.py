"""Token-id output: documents packed best-fit decreasing into rows of a fixed-width id matrix.

Each task reads its documents in stretches of a bounded number of tokens and packs each stretch by itself, so there
is no shuffle, a hot source is no concern, and memory is bounded. Among the open rows a segment tree over remaining
capacities finds the fullest one that a piece still fits. A row holds its ids, little-endian and padded to the
width, the cumulative lengths of its segments, and position ids that start again at each segment.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tokenize import encoder, pieces_of

#: Padding is told by a row's n_tokens, not by its id.
WIDTH, EOS, PAD = 2048, 50256, 50256
#: Tokens that a task packs at once.
STRETCH = 3_000_000
ROWS = "shard string, row int, n_tokens int, input_ids binary, cu_seqlens array<int>, position_ids binary, doc_ids array<{kind}>, pieces array<int>, starts array<long>"


class CapacityTree:
    """Open rows by remaining capacity; finds the smallest capacity that is at least a length."""

    def __init__(self, top: int):
        self.size = 1 << top.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(top + 1)]

    def add(self, capacity: int, row: int):
        self.rows[capacity].append(row)
        i = capacity + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def pop_at_least(self, length: int) -> tuple[int, int] | None:
        """(capacity, row) of the best fit, taken out; None if no open row has room."""
        i = length + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.size
        row = self.rows[capacity].pop()
        while i:
            self.count[i] -= 1
            i >>= 1
        return capacity, row


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[int]]:
    """Rows as lists of piece indices, longest pieces first; ties in the order given."""
    tree, rows = CapacityTree(width), []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = tree.pop_at_least(lengths[k])
        if found is None:
            rows.append([])
            found = (width, len(rows) - 1)
        capacity, row = found
        rows[row].append(k)
        if capacity > lengths[k]:
            tree.add(capacity - lengths[k], row)
    return rows


def id_type(tokenizer: str) -> str:
    """Little-endian type that holds all ids of the tokenizer file."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"


def packed_rows(docs: DataFrame, tokenizer: str, width: int = WIDTH, eos: int = EOS, pad: int = PAD) -> DataFrame:
    """The packed matrix, a row of DataFrame for each of its rows.

    shard and row name it: stretches of tasks, and rows in them. Every document, with the end token appended, occurs
    whole and in order: pieces longer than the width are cut without loss, the shorter first. doc_ids, pieces and starts
    give each segment's document, piece number and first token there. Null and empty texts are the end token alone;
    repeated rows are packed as often as they occur; a null doc_id stays null; other columns are ignored. An empty
    table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    dtype = id_type(tokenizer)

    def pack(part: list[tuple], shard: str) -> pd.DataFrame:
        out = []
        for number, members in enumerate(best_fit_decreasing([len(p[3]) for p in part], width)):
            segments = [part[k] for k in members]
            ids = np.full(width, pad, dtype=dtype)
            cuts = np.cumsum([0, *(len(s[3]) for s in segments)])
            positions = np.zeros(width, dtype="<u2" if width <= 1 << 16 else "<u4")
            for (_, _, _, own), a, b in zip(segments, cuts, cuts[1:]):
                ids[a:b] = own
                positions[a:b] = np.arange(b - a)
            out.append((shard, number, int(cuts[-1]), ids.tobytes(), cuts.tolist(), positions.tobytes(), [s[0] for s in segments], [s[1] for s in segments], [s[2] for s in segments]))
        return pd.DataFrame(out, columns=[c.split()[0] for c in ROWS.split(", ")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, task, part, size, stretch = encoder(tokenizer), TaskContext.get().partitionId(), [], 0, 0
        for batch in batches:
            doc_ids = [d if d is None or kind == "string" else int(d) for d in batch["doc_id"]]
            for doc_id, text in zip(doc_ids, batch["text"]):
                ids = encode(text or "")
                ids.append(eos)
                ids = np.frombuffer(ids, dtype=np.uint32).astype(dtype)
                part += [(doc_id, k, start, ids[start : start + n]) for k, (start, n) in enumerate(pieces_of(len(ids), width))]
                size += len(ids)
                if size >= STRETCH:
                    yield pack(part, f"{task:06d}-{stretch:04d}")
                    part, size, stretch = [], 0, stretch + 1
        if part:
            yield pack(part, f"{task:06d}-{stretch:04d}")

    # ids travel as text: beside a null, pandas would hold whole numbers as floating ones
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, ROWS.format(kind=kind))


def write(rows: DataFrame, path: str) -> DataFrame:
    """Write packed rows as Parquet with binary matrices, zstandard-compressed, and return the written table."""
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def unpack(rows: DataFrame, dtype: str = "<u2") -> DataFrame:
    """The segments again: doc_id, piece, start, length, ids_crc32 (of little-endian 32-bit ids), shard, row and offset,
    read from the written matrices. Positions that do not start again at each segment are an error."""
    field = next(f for f in rows.schema.fields if f.name == "doc_ids")
    kind = field.dataType.elementType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                ids = np.frombuffer(r.input_ids, dtype=dtype).astype("<u4")
                places = np.frombuffer(r.position_ids, dtype="<u2" if len(r.position_ids) == 2 * len(ids) else "<u4")
                for k, (a, b) in enumerate(zip(r.cu_seqlens[:-1], r.cu_seqlens[1:])):
                    if places[a] != 0 or places[b - 1] != b - a - 1:
                        raise ValueError(f"positions of row {r.row} of shard {r.shard} do not start again at {a}")
                    out.append((None if r.doc_ids[k] is None or r.doc_ids[k] != r.doc_ids[k] else str(r.doc_ids[k]), int(r.pieces[k]), int(r.starts[k]), int(b - a), zlib.crc32(ids[a:b].tobytes()), r.shard, int(r.row), int(a)))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "shard", "row", "offset"])

    texts = rows.withColumn("doc_ids", F.col("doc_ids").cast("array<string>"))
    return texts.mapInPandas(cut, f"doc_id string, piece int, start long, length long, ids_crc32 long, shard string, row int, offset long").withColumn("doc_id", F.col("doc_id").cast(kind))
