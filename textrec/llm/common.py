"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec.session import ship_package

#: Text is taken from an Arrow batch in slices of about this many bytes, so
#: that the Python objects made from a batch stay small however long it is.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id written as text; held-out rows are those with 2 mod 4."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(id_crc(doc_id), F.lit(4)) == 2, F.lit(False))


def is_held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def column_texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Whole texts of a string column; null counts as empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of a batch, each of about ``limit`` bytes of text
    (a longer single text is a range of its own)."""
    if not batch.num_rows:
        return
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)


def text_slices(batches: Iterable[pa.RecordBatch], text: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """(rows, their texts) over all batches of a task."""
    for batch in batches:
        for rows in slices(batch, text, limit):
            yield rows, column_texts(rows.column(rows.schema.get_field_index(text)))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; whatever else the
    table holds can't clash with the columns that the operator adds."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def id_type(df: DataFrame, column: str = "doc_id") -> str:
    return dict(df.dtypes)[column]


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def dataset_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, in its order."""
    return df.select(*[df[f"`{c}`"] for c in like.columns])


def keep_where(df: DataFrame, mask_of, text_col: str = "text") -> DataFrame:
    """Rows of ``df`` (all columns unchanged) whose text ``mask_of(texts)`` keeps."""
    schema = df.schema

    def run(batches):
        for rows, texts in text_slices(batches, text_col):
            kept = rows.filter(pa.array(mask_of(texts), pa.bool_()))
            if kept.num_rows:
                yield kept

    return df.mapInArrow(run, schema)
