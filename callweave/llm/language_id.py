"""Language identification by compression.

Each language has a zstandard raw-content dictionary of its own texts. The language whose
dictionary leaves the fewest bytes is chosen; a narrow margin to the next one is a rejection.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window, functions as F, types as T

from callweave.llm.text import bucket, documents, slices, utf8, with_columns

LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


def learn_dictionaries(rows: DataFrame, text: str = "text", lang: str = "lang",
                       key: str = "doc_id", rows_per_lang: int = 96,
                       chars_per_row: int = 2048) -> dict[str, bytes]:
    """A dictionary for each language from a bounded sample of labelled rows.

    For each language the ``rows_per_lang`` rows first in a hash order are used, with at most
    ``chars_per_row`` characters each; nothing else reaches the driver. Rows without language
    or text teach nothing.
    """
    piece = F.lower(F.substring(F.trim(F.col(text)), 1, chars_per_row))
    order = Window.partitionBy("lang").orderBy("place", "piece")
    picked = (
        rows.where(F.col(lang).isNotNull() & (F.length(F.trim(F.col(text))) > 0))
        .select(F.col(lang).cast("string").alias("lang"), piece.alias("piece"),
                F.xxhash64(F.col(key).cast("string")).alias("place"))
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows_per_lang)
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("n", "piece"))).alias("got"))
    )
    return {r["lang"]: "\n".join(g["piece"] for g in r["got"]).encode()
            for r in sorted(picked.collect(), key=lambda r: r["lang"])}


class Compressors:
    """One compressor for each language."""

    def __init__(self, dictionaries: dict[str, bytes], level: int):
        self.languages = list(dictionaries)
        self.packs = []
        for content in dictionaries.values():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.packs.append(zstandard.ZstdCompressor(
                level=level, dict_data=d, write_content_size=False, write_dict_id=False))

    def sizes(self, data: bytes, piece: int) -> list[int]:
        """Compressed bytes of the whole text, in pieces so that the dictionary, not the
        earlier text, is what explains each of them."""
        parts = [data[i:i + piece] for i in range(0, len(data), piece)]
        return [sum(len(p.compress(x)) for x in parts) for p in self.packs]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text",
             level: int = 6, piece: int = 8192, margin: float = 0.02) -> DataFrame:
    """Every row with ``lang_pred``, ``score`` and ``rejected``; case is folded.

    ``score`` is the share of bytes that the best language saves against the next one (0 to 1;
    1 where there is only one language); below ``margin`` the row is marked ``rejected`` and
    keeps its best guess. A text that is missing or has no letter is ``und`` with score 0 and
    rejected, and so is every text where no language was learned; of equal languages the first
    by name is taken. Columns of ``docs`` with these names are replaced. Rows are treated one
    by one and whole.
    """
    names = ("lang_pred", "score", "rejected")
    gone = tuple(c for c in docs.columns if c.lower() in names)
    schema = T.StructType([f for f in docs.schema.fields if f.name not in gone] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(dict(sorted(dictionaries.items())))

    def judge(model: Compressors, raw: bytes | None) -> tuple[str, float, bool]:
        t = (raw or b"").decode()
        if not model.packs or not LETTER.search(t):
            return UNKNOWN, 0.0, True
        sizes = model.sizes(t.lower().encode(), piece)
        (best, at), *rest = sorted((s, i) for i, s in enumerate(sizes))
        score = 1.0 - best / rest[0][0] if rest else 1.0
        return model.languages[at], score, score < margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Compressors(shared.value, level)
        for batch in slices(batches, text):
            lang, score, rejected = zip(*(judge(model, raw) for raw in utf8(batch, text)))
            yield with_columns(batch, {
                "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64()),
                "rejected": pa.array(rejected, pa.bool_())}, gone)

    return docs.mapInArrow(run, schema)


def op8_language(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a quarter by id is held out from learning."""
    docs = documents(spark, sf_dir)
    held_out = bucket(F.col("doc_id"), 4) == 2
    dictionaries = learn_dictionaries(docs.where(~held_out).select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), dictionaries).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
