"""Near-duplicate documents: SuperMinHash, banding, exact verification and union-find grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.bands import PERCENT, band_keys, bands_needed, groups, sketches
from tripforge.llm.flat import lower_case, ragged, shingles, slices
from tripforge.llm.superminhash import signatures
from tripforge.session import Workspace

ROWS = 4


def signed(docs: DataFrame, rows: int = ROWS, percent: int = PERCENT) -> DataFrame:
    """doc_id, number of shingles, a 128-bit digest of the shingle set, and the set's band keys and sketch."""
    bands = bands_needed(rows, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch["text"]):
                values, bounds = shingles(lower_case(part))
                digests = [xxhash.xxh3_128_digest(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                registers = signatures(values, bounds, bands * rows)
                keys = band_keys(registers, rows)
                sizes = np.diff(bounds)
                ends = np.concatenate(([0], np.cumsum(np.where(sizes > 0, bands, 0))))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"][part.first : part.last].cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        ragged(keys[sizes > 0].ravel(), ends, pa.int64()),
                        sketches(registers),
                    ],
                    ["doc_id", "n_shingles", "digest", "bands", "sketch"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(item, values): the whole shingle set of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch["text"]):
                values, bounds = shingles(lower_case(part))
                ids = batch["doc_id"][part.first : part.last].cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, ragged(values.view(np.int64), bounds, pa.int64())], ["item", "values"])

    return docs.select("doc_id", "text").mapInArrow(run, "item long, values array<long>")


def near_duplicates(docs: DataFrame, work: Workspace, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, and ``n_copies`` of the same set.

    Words are lower-cased (A-Z) runs without white space; a text's set holds its
    distinct five-word shingles, or its whole sequence if it has fewer words.
    Documents are linked when the intersection is at least ``percent`` of the
    union; ``component_id`` is the smallest id that links reach. A text without
    words, or a null one, is linked with nothing. Equal sets form one class
    first, which its smallest id stands for, so a set with very many copies
    takes part once. A row without an id belongs to the class of its set but
    links no classes; repeated rows of an id, whatever their texts, count as one
    document with the sets of all of them. Other columns are ignored.
    """
    rows = work.store(signed(docs, percent=percent), "signed")
    filled = rows.where("n_shingles > 0")
    classes = work.store(filled.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies")), "classes")
    heads = filled.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"])
    items = work.store(heads.selectExpr("doc_id AS item", "n_shingles AS size", "bands", "sketch"), "items")
    texts = docs.select("doc_id", "text")

    def sets_of(ids: DataFrame) -> DataFrame:
        return shingle_sets(texts.join(ids.withColumnRenamed("item", "doc_id"), "doc_id"))

    roots, _ = groups(items, sets_of, work, percent)
    member = rows.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    joined = member.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("root", "rep", "doc_id").alias("component_id")
    out = joined.select("doc_id", "n_shingles", component, F.coalesce("n_copies", F.lit(1)).alias("n_copies"))
    return out.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "n_copies"
    )
