"""Spans of a text: (kind, start, end, base), in code points, end exclusive."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm.common import release, slices

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

Span = tuple[str, int, int, bool]


def in_order(spans: list[Span], kinds: list[str]) -> list[Span]:
    """By start, then by kind as listed."""
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def found(docs: DataFrame, finder: Callable[[], Callable[[str], list[Span]]], text: str = "text",
          keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``spans`` of every row's whole text (null: empty). ``finder()`` gives a task its search."""
    out = T.StructType([*[docs.schema[c] for c in keep], T.StructField("spans", SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        find = finder()
        for b in slices(batches):
            got = [[dict(zip(("kind", "start", "end", "base"), s)) for s in find(x)] if x else []
                   for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, _ARROW)], out.names)

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, out)


def counted(spans: str, kind: str) -> Column:
    """How many base spans are of a kind."""
    return F.size(F.filter(F.col(spans), lambda s: s.base & (s.kind == kind))).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def base_digest(spans: str) -> Column:
    return F.sha2(listed(F.filter(F.col(spans), lambda s: s.base)), 256)
