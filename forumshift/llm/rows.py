"""Row-wise Arrow passes over a text column: every output row belongs to one input row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumshift.llm.shipping import arrow_map


def per_text(df: DataFrame, id_col: str, text_col: str, fields: list[tuple[str, pa.DataType, T.DataType]],
             make: Callable[[], Callable[[str], tuple]]) -> DataFrame:
    """(doc_id, *fields) for every row of ``df``; ``make()`` runs once per task and returns the
    function from a whole text (null: empty) to the field values.  Texts are held one Arrow
    batch at a time; results leave in small batches."""
    schema = pa.schema([("doc_id", pa.int64())] + [(n, t) for n, t, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                rows = [one(x.as_py() or "") for x in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array([r[i] for r in rows], f[1]) for i, f in enumerate(fields)],
                    schema=schema)

    out = T.StructType([T.StructField("doc_id", T.LongType())] + [T.StructField(n, t) for n, _, t in fields])
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(texts, run, out)


def rewrite_text(df: DataFrame, text_col: str, make: Callable[[], Callable[[str | None], str | None]]) -> DataFrame:
    """``df`` with its text column rewritten in place; ``None`` drops the row.  Other columns,
    whatever their names, pass through; ``n_chars``, where present, follows the new text."""
    names, out = df.columns, df.schema
    at, count = names.index(text_col), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                old = part.column(at).to_pylist()
                new = [one(x) for x in old]
                keep = [i for i, x in enumerate(new) if x is not None or old[i] is None]
                cols = [c.take(pa.array(keep, pa.int64())) for c in part.columns]
                texts = [new[i] for i in keep]
                cols[at] = pa.array(texts, cols[at].type)
                if count is not None:
                    cols[count] = pa.array([None if x is None else len(x) for x in texts], cols[count].type)
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return arrow_map(df, run, out)


def keep_rows(df: DataFrame, text_col: str, make: Callable[[], Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """The rows of ``df`` for which the function of the text column gives true."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = make()
        for b in batches:
            yield b.filter(mask(b.column(at)))

    return arrow_map(df, run, df.schema)
