"""Rows in order of their ids, cut into parts of bounded size, without bringing them together."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import stored, tidy

PART_ROWS = 4_000  # rows in a part, about
MOST_PARTS = 50_000  # beyond that, parts grow


def in_order(
    rows: DataFrame,
    work: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    columns: str,
    ties: str,
    descending: bool = False,
    lend: bool = False,
) -> DataFrame:
    """``part``, ``lent``, ``doc_id`` and the columns of ``work``, dealt by part and sorted within it.

    Parts are numbered in order and hold whole ranges of ids, null ids last; rows of one id are ordered by
    the column ``ties``. ``work`` makes the columns from a batch of rows, before they are dealt. With
    ``lend``, the rows of each part's first id are also given to the part before it, behind its own rows
    and with ``lent`` true (those of the first part to the last). The driver sees the cut points and first
    ids only, one of each a part, which it finds from the ids alone.
    """
    ids = stored(rows.select(F.col("doc_id").cast("bigint").alias("doc_id")))
    parts = max(1, min(MOST_PARTS, -(-ids.count() // PART_ROWS)))
    shares = [k / parts for k in range(1, parts)]
    found = ids.stat.approxQuantile("doc_id", shares, 0.1 / parts) if shares else []
    cuts = np.unique(np.array(found, np.int64))

    def part_of(doc_ids: pa.Array) -> np.ndarray:
        known = np.searchsorted(cuts, doc_ids.fill_null(0).to_numpy(zero_copy_only=False))
        known = len(cuts) - known if descending else known
        return np.where(doc_ids.is_null().to_numpy(zero_copy_only=False), len(cuts) + 1, known)

    def first_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id")
            table = pa.table({"part": pa.array(part_of(doc_ids), pa.int64()), "doc_id": doc_ids})
            kind = "max" if descending else "min"
            least = table.group_by("part").aggregate([("doc_id", kind)])
            yield from least.rename_columns(["part", "doc_id"]).to_batches()

    lent_to: dict[int | None, int] = {}
    if lend:
        best = F.max("doc_id") if descending else F.min("doc_id")
        firsts = ids.mapInArrow(first_ids, "part bigint, doc_id bigint")
        firsts = firsts.groupBy("part").agg(best.alias("doc_id")).orderBy("part").collect()
        lent_to = {r["doc_id"]: firsts[i - 1]["part"] for i, r in enumerate(firsts)}

    @tidy
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id")
            made = {
                "part": pa.array(part_of(doc_ids), pa.int64()),
                "lent": pa.array(np.zeros(batch.num_rows, bool)),
                "doc_id": doc_ids,
            } | work(batch)
            own = pa.RecordBatch.from_pydict(made)
            yield own
            guests = [i for i, d in enumerate(doc_ids.to_pylist()) if d in lent_to] if lend else []
            if guests:
                taken = own.take(pa.array(guests))
                to = [lent_to[d] for d in taken.column("doc_id").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {c: taken.column(c) for c in made}
                    | {"part": pa.array(to, pa.int64()), "lent": pa.array([True] * len(to))}
                )

    keyed = rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    dealt = keyed.mapInArrow(deal, f"part bigint, lent boolean, doc_id bigint, {columns}")
    way = F.col("doc_id").desc_nulls_last() if descending else F.col("doc_id").asc_nulls_last()
    return dealt.repartition(len(cuts) + 1, "part").sortWithinPartitions("part", "lent", way, ties)
