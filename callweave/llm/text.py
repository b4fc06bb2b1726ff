"""What several of the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callweave.sources.tables import read_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space as a regular expression; every other character belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, "documents", root=sf_dir)


def folded_words(data: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z in lower case. ``bytes.lower`` and ``bytes.split`` know
    ASCII only, which is the definition: words are the runs outside ``\\x20\\x09-\\x0D``."""
    return data.lower().split() if data else []


def bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return column(batch, name).cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = 1 << 20):
    """The same rows in record batches of about ``size`` bytes of text each (a longer text is
    a batch of its own), so that what a Python worker holds does not follow the batch size."""
    for batch in batches:
        start, held = 0, 0
        lengths = pc.binary_length(column(batch, text)).fill_null(0).to_pylist()
        for i, n in enumerate(lengths):
            if i > start and held + n > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start)


def with_columns(batch: pa.RecordBatch, added: dict[str, pa.Array],
                 without: tuple[str, ...] = ()) -> pa.RecordBatch:
    """The batch with columns added at the end, and those ``without`` left out."""
    kept = {n: c for n, c in zip(batch.schema.names, batch.columns) if n not in without}
    return pa.RecordBatch.from_pydict({**kept, **added})


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the next name that no column of ``df`` has (without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
