"""Exact duplicates through content-defined chunk recipes.

A text (A-Z lowered, UTF-8, null as empty) is cut where a rolling hash of its last 32 bytes says so. Its recipe is the ordered list of
its chunks' identifiers. An identifier is a keyed 128-bit digest, and it is verified: distinct chunk contents meet once, and if two
contents ever share a digest, all digests are made anew with the next key. After that, equal recipes mean equal texts, so the
texts themselves are never sorted, grouped or joined; only recipes of a few bytes per kilobyte are.

Edge cases: null and empty texts equal each other; rows with one ``doc_id`` and text share ``kept``; a group whose ids
are all null has a null ``keep_id`` and all its rows stay; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.shared import ascii_lower, stored, without

SMALLEST, LARGEST, MEAN_BITS, WINDOW = 512, 16384, 11, 32
BLOCK = 1 << 20
ROWS = 256
_GEAR = np.random.default_rng(20240601).integers(0, 1 << 32, 256, dtype=np.uint32)

RECIPE_SCHEMA = "doc_id long, n_bytes long, recipe binary, text_sha256 string"
CHUNK_SCHEMA = "digest binary, chunk binary"


def _cut_points(data: bytes) -> Iterator[int]:
    """Ends of the places where the hash of the last ``WINDOW`` bytes has its top bits zero."""
    for start in range(0, len(data), BLOCK):
        lead = min(start, WINDOW - 1)
        h = _GEAR[np.frombuffer(data, np.uint8, min(BLOCK, len(data) - start) + lead, start - lead)]
        for step in (1, 2, 4, 8, 16):
            wider = h.copy()
            wider[step:] += h[:-step] << np.uint32(step)
            h = wider
        for at in np.flatnonzero(h[lead:] >> np.uint32(32 - MEAN_BITS) == 0).tolist():
            yield start + at + 1


def chunks(data: bytes) -> list[bytes]:
    """``data`` in pieces of SMALLEST..LARGEST bytes (the last may be shorter) whose borders depend on nearby content only."""
    out, start = [], 0
    for end in _cut_points(data) if len(data) > SMALLEST else ():
        while end - start > LARGEST:
            out.append(data[start:start + LARGEST])
            start += LARGEST
        if end - start >= SMALLEST:
            out.append(data[start:end])
            start = end
    while start < len(data):
        out.append(data[start:start + LARGEST])
        start += LARGEST
    return out


def _digest(chunk: bytes, key: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16, key=key).digest()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part.column(0), part.column(1).cast(pa.binary()).to_pylist()


def _recipes(docs: DataFrame, key: bytes) -> DataFrame:
    def build(batches):
        for ids, texts in _rows(batches):
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(t) for t in texts], pa.int64()),
                pa.array([b"".join(_digest(c, key) for c in chunks(t)) for t in texts], pa.binary()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ], names=["doc_id", "n_bytes", "recipe", "text_sha256"])

    return docs.mapInArrow(build, RECIPE_SCHEMA)


def _clashes(docs: DataFrame, key: bytes) -> DataFrame:
    """Digests that stand for more than one content; every distinct content of a task moves once."""

    def build(batches):
        for _, texts in _rows(batches):
            found = {c: _digest(c, key) for t in texts for c in chunks(t)}
            yield pa.RecordBatch.from_arrays([pa.array(list(found.values()), pa.binary()), pa.array(list(found), pa.binary())], names=["digest", "chunk"])

    contents = docs.mapInArrow(build, CHUNK_SCHEMA).groupBy("digest", "chunk").agg(F.count(F.lit(1)).alias("n"))
    return contents.groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")


def recipes(documents: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_bytes, recipe (its verified chunk identifiers in order), text_sha256."""
    docs = documents.select(F.col("doc_id").cast("long"), ascii_lower(F.coalesce("text", F.lit(""))).alias("text"))
    attempt = 0
    while True:
        key = b"chunk recipe %d" % attempt
        if _clashes(docs, key).isEmpty():
            return stored(_recipes(docs, key), "recipes")
        attempt += 1


def exact_groups(documents: DataFrame) -> DataFrame:
    """A row per document: doc_id, keep_id (largest id of its group of equal texts), group_size, kept, text_sha256."""
    made = recipes(documents)
    same = ["n_bytes", "recipe"]
    groups = made.groupBy(*same).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    several = stored(groups.where("group_size > 1"), "copies")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return made.join(several, same, "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def drop_copies(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each group of equal texts, columns as they are; rows of a group without any id all stay.

    Rows are told apart by id and text: another text under a dropped row's id stays, and of repeated rows one.
    """
    copies = exact_groups(documents).where("group_size > 1 AND keep_id IS NOT NULL")
    rows = stored(copies.groupBy(F.col("doc_id").alias("dropped_id"), F.col("text_sha256").alias("dropped_key"), "kept").agg(F.count(F.lit(1)).alias("n")), "copies")
    marks = lambda which: rows.where(which).select("dropped_id", "dropped_key")
    return without(documents, stored(marks("NOT kept"), "dropped"), stored(marks("kept AND n > 1"), "repeated"))
