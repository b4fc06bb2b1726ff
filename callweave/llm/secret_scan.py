"""Secret scans by dictionary-primed zstandard novelty.

Fixed patterns find assignments, access keys and long hexadecimal runs. Beyond these, a run of
key-like characters near a sensitive word is compressed with a raw-content dictionary made of
common identifiers and the text around it. What such a dictionary cannot shorten is neither a
name in use nearby nor an ordinary identifier, and is reported as ``novel``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from callweave.llm.text import documents, slices, utf8, with_columns

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
#: A run of at least the wanted length is the same match as a longer pattern checked later:
#: both start at the first character and take the whole run.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SENSITIVE = re.compile(
    r"(?ai:pass|pwd|secret|token|key|auth|bearer|credential|private|login|signature|salt)")
#: From this length on zstandard codes the characters themselves by their frequency, so that a
#: random run of few different characters gets shorter too; longer runs are packed without that.
ENTROPY_CODED = 64
#: Common identifiers that prime each dictionary.
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key secret_key private_key "
    "client_id client_secret authorization bearer credential username user_name login session "
    "signature certificate public_key encryption_key connection_string environment "
    "configuration settings default example placeholder changeme your_password_here "
    "your_token_here abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
    "1234567890 xxxxxxxxxxxxxxxx 0000000000000000 application controller repository service "
    "manager handler request response parameter attribute property function variable constant "
    "localhost http https www com org html index document version build release timestamp"
).encode()

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                     T.StructField("end", T.IntegerType())])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; leftmost and not overlapping per kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def marginal_bytes(candidate: bytes, around: bytes, level: int = 3) -> int:
    """Bytes that the candidate adds to what its surroundings and identifiers explain."""
    primed = zstandard.ZstdCompressionDict(IDENTIFIERS + b"\n" + around,
                                           dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    flags = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if len(candidate) < ENTROPY_CODED:
        pack = zstandard.ZstdCompressor(level=level, dict_data=primed, **flags)
    else:  # a target length keeps the literals of the fast strategy as they are
        pack = zstandard.ZstdCompressor(
            dict_data=primed, compression_params=zstandard.ZstdCompressionParameters.from_level(
                level, strategy=zstandard.STRATEGY_FAST, target_length=1, min_match=4, **flags))
    return len(pack.compress(candidate)) - len(pack.compress(b""))


def novel_spans(text: str, taken: list[tuple[int, int, int]], near: int, around: int,
                novelty: float) -> list[tuple[int, int, int]]:
    """Incompressible runs in a sensitive context, outside the spans already found."""
    found = []
    for m in CANDIDATE.finditer(text):
        run = m[0]
        if not any(c.isdigit() for c in run) or not any(c.isalpha() for c in run):
            continue
        start, end = m.span()
        if not SENSITIVE.search(text, max(0, start - near), start):
            continue
        if any(s < end and start < e for s, _, e in taken):
            continue
        before, after = text[max(0, start - around):start], text[end:end + around]
        if marginal_bytes(run.encode(), (after + "\n" + before).encode()) >= novelty * len(run):
            found.append((start, 3, end))
    return found


def find_secrets(docs: DataFrame, text: str = "text", near: int = 40, around: int = 256,
                 novelty: float = 0.85) -> DataFrame:
    """Every row with ``spans``: (kind, start, end) in code points, end exclusive, ordered by
    start, then kind.

    A candidate is judged ``novel`` where its marginal compressed size reaches ``novelty`` of
    its length; a sensitive word must lie in the ``near`` characters before it, and ``around``
    characters on both sides prime the dictionary. A missing or empty text has an empty list.
    A column of ``docs`` named ``spans`` is replaced. Rows are treated one by one.
    """
    names = tuple(c for c in docs.columns if c.lower() == "spans")
    schema = T.StructType([f for f in docs.schema.fields if f.name not in names]
                          + [T.StructField("spans", T.ArrayType(SPAN))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            spans = []
            for raw in utf8(batch, text):
                t = (raw or b"").decode()
                base = base_spans(t)
                spans.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(
                    base + novel_spans(t, base, near, around, novelty))])
            yield with_columns(batch, {"spans": pa.array(spans, kind)}, names)

    return docs.mapInArrow(run, schema)


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    """Counts and digests of the spans of every document."""
    found = find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] != "novel")

    def listed(a):
        return F.array_join(F.transform(a, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), count("novel"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(spans).alias("spans"),
    )
