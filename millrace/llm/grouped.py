"""Work on the groups of sorted partitions, in bounded memory and without a task for each group."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from millrace.llm.storage import give_back

#: Rows, and bytes of their binary fields, that go back to Spark at once.
ROWS, BYTES = 20_000, 4 << 20


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a partition sorted by keys."""
    held: list[pd.DataFrame] = []  # pieces of the group that the next batch may continue
    for batch in batches:
        if not len(batch):
            continue
        change = np.zeros(len(batch), dtype=bool)
        for k in keys:
            x = batch[k].to_numpy()
            change[1:] |= x[1:] != x[:-1]
        cuts = [0, *np.flatnonzero(change), len(batch)]
        if held and any(held[-1][k].iloc[-1] != batch[k].iloc[0] for k in keys):
            yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
            held = []
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            held.append(batch.iloc[a:b])
            yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
            held = []
        held.append(batch.iloc[cuts[-2] :])
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def flushed(rows: Iterable[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    """Rows as frames of bounded size."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if len(out) >= ROWS or size >= BYTES:
            yield pd.DataFrame(out, columns=names)
            out, size = [], 0
    if out:
        yield pd.DataFrame(out, columns=names)


def by_group(df: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], Iterable[tuple]], schema: str, order: list[str] | None = None) -> DataFrame:
    """Rows that work returns for each group of keys."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from flushed((row for group in groups(batches, keys) for row in work(group)), names)
        give_back()

    return df.repartition(*keys).sortWithinPartitions(*keys, *(order or [])).mapInPandas(run, schema)
