"""Substring dedup: paragraphs by MinHash banding, exact verification and components; passages by windows of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge.llm.bands import MISS, PERCENT, band_keys, bands_needed, groups, sketches
from tripforge.llm.flat import _PLACES, U64, Slice, lower_case, mixed, prefix_sums, ragged, shingles, slices, span_hashes, words
from tripforge.llm.winnow import Screen, screen
from tripforge.session import Workspace

#: Paragraphs have at least this many words; windows have just so many.
MIN_WORDS = 25
#: Of so many neighbouring places where a window may start, one is taken at least.
PLACES = 26
#: The place is taken by the hash of so many words.
GRAM = 3
#: Bits of a band key. Short keys take less disk; two that meet by chance cost a comparison, as links are confirmed on full sets.
KEY_BITS = 40

_NEWLINE = 10


def tuned(percent: int = PERCENT, miss: float = MISS, most: int = 6, noise: float = 0.2, passing: float = 0.6) -> tuple[int, int]:
    """(bands, rows) for high recall: of the settings that keep a miss below ``miss``, the one with fewest band keys
    that lets at most ``passing`` of the pairs of similarity ``noise`` through."""
    options = [(bands_needed(rows, percent, miss), rows) for rows in range(1, most + 1)]
    return min(x for x in options if 1 - (1 - noise ** x[1]) ** x[0] <= passing)


def minhash(values: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Least value of each of ``size`` hash functions over each set, which must not be empty."""
    registers = np.empty((len(bounds) - 1, size), U64)
    for at, seed in enumerate(mixed(np.arange(1, size + 1, dtype=U64))):
        registers[:, at] = np.minimum.reduceat((values ^ seed) * (seed | U64(1)) ^ ((values ^ seed) >> U64(29)), bounds[:-1])
    return registers


def paragraphs(part: Slice) -> tuple[Slice, np.ndarray, np.ndarray]:
    """Lines as rows of a slice, with the row and line number of each."""
    breaks = np.flatnonzero(part.data == _NEWLINE) + 1
    starts = np.union1d(part.starts[:-1], breaks[breaks < len(part.data)]) if len(part.data) else np.zeros(0, np.int64)
    starts = starts[starts < len(part.data)]
    row = np.searchsorted(part.starts, starts, "right") - 1
    before = np.searchsorted(breaks, part.starts[row], "right")
    line = np.searchsorted(breaks, starts, "right") - before
    return Slice(0, len(starts), part.data, np.append(starts, len(part.data))), row, line


def joined_lines(lines: Slice, row: np.ndarray, number: np.ndarray) -> tuple[Slice, np.ndarray, np.ndarray, np.ndarray]:
    """Lines with neighbouring shorter ones of a text joined up to the next blank or long line, and how many lines each has."""
    counts = np.bincount(words(lines)[2], minlength=lines.last)
    short = (counts > 0) & (counts < MIN_WORDS)
    fresh = np.ones(lines.last, bool)
    fresh[1:] = ~(short[1:] & short[:-1] & (row[1:] == row[:-1]))
    at = np.flatnonzero(fresh)
    sizes = np.diff(np.append(at, lines.last))
    return Slice(0, len(at), lines.data, np.append(lines.starts[at], len(lines.data))), row[at], number[at], sizes


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, Slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, paragraphs, their rows, first lines, numbers of lines and shingle sets of each slice of a batch."""
    for part in slices(batch["text"]):
        lines, row, number, sizes = joined_lines(*paragraphs(part))
        values, bounds = shingles(lower_case(lines))
        ids = batch["doc_id"][part.first : part.last].cast(pa.int64())
        yield ids, lines, row, number, sizes, values, bounds


def _long(lines: Slice) -> np.ndarray:
    _, _, owner = words(lines)
    return np.flatnonzero(np.bincount(owner, minlength=lines.last) >= MIN_WORDS)


def window_starts(hashes: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows that are taken, and a hash of each window's words.

    Of every ``PLACES`` neighbouring places of a text the one with the least
    hash of ``GRAM`` words is taken, so texts that share ``PLACES + MIN_WORDS - 1``
    words in a row take the same window there. Of equal windows that overlap
    only those needed to cover their words are left.
    """
    none = np.zeros(0, np.int64)
    counts = np.maximum(np.bincount(owner, minlength=rows) - MIN_WORDS + 1, 0)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if rows else 0
    if not total:
        return none, none
    text = np.repeat(np.arange(rows), counts)
    place = np.arange(total)
    word = np.searchsorted(owner, np.arange(rows))[text] + place - (ends - counts)[text]
    gram = np.zeros(total, U64)
    for k in range(GRAM):
        gram += hashes[word + k] * _PLACES[k]
    low = U64((1 << 24) - 1)
    keys = (mixed(gram) & ~low) | (low - (place.astype(U64) & low))
    least, reach = keys.copy(), 1
    while reach < PLACES and reach < total:
        step = min(reach, PLACES - reach)
        least = np.minimum(least[: len(least) - step], least[step:])
        reach += step
    least = least[: max(0, total - PLACES + 1)] if reach == PLACES else least[:0]
    whole = text[: len(least)] == text[PLACES - 1 :][: len(least)]
    few = np.flatnonzero((counts > 0) & (counts < PLACES))
    first = (ends - counts)[few]
    lone = np.array([keys[a:b].min() for a, b in zip(first, ends[few], strict=True)], U64)
    chosen, base = np.concatenate((least[whole], lone)), np.concatenate((np.flatnonzero(whole), first))
    taken = np.unique(base + ((low - (chosen & low) - base.astype(U64)) & low).astype(np.int64))
    made = np.zeros(len(taken), U64)
    for k in range(MIN_WORDS):
        made += hashes[word[taken] + k] * _PLACES[k]
    made = mixed(made)
    fresh = np.ones(len(taken), bool)
    fresh[1:] = (made[1:] != made[:-1]) | (text[taken[1:]] != text[taken[:-1]]) | (np.diff(taken) >= MIN_WORDS)
    since = (taken - taken[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]) // (MIN_WORDS // 2)
    needed = fresh | np.append(fresh[1:], True)
    needed[1:] |= since[1:] != since[:-1]
    return word[taken[needed]], made[needed].view(np.int64)


def windows(docs: DataFrame) -> DataFrame:
    """doc_id, start, end (in characters), first and last line, and hash of the windows of each text, wherever its lines break."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch["text"]):
                starts, ends, owner = words(part)
                hashes = span_hashes(prefix_sums(lower_case(part).data), starts, ends)
                at, made = window_starts(hashes, owner, part.last - part.first)
                points = np.concatenate(([0], np.cumsum((part.data & 0xC0) != 0x80)))
                breaks = np.concatenate(([0], np.cumsum(part.data == _NEWLINE)))
                row = owner[at]
                above = breaks[part.starts[row]]
                lines = [breaks[starts[at]] - above, breaks[starts[at + MIN_WORDS - 1]] - above] if len(at) else [at, at]
                before = points[part.starts[row]]
                spans = [points[starts[at]] - before, points[ends[at + MIN_WORDS - 1]] - before] if len(at) else [at, at]
                ids = batch["doc_id"][part.first : part.last].cast(pa.int64())
                columns = [ids.take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (*spans, *lines, made))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "end", "line", "last_line", "window"])

    schema = "doc_id long, start long, end long, line long, last_line long, window long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _chosen(values: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(bounds)[rows]
    ends = np.concatenate(([0], np.cumsum(counts)))
    places = np.repeat(bounds[rows] - ends[:-1], counts) + np.arange(ends[-1])
    return values[places], ends


def _items(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each set; equal sets share it."""
    made = [xxhash.xxh3_64_intdigest(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return np.array(made, U64).view(np.int64)


def signed_paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, first line, number of lines, item, size and band keys of each paragraph."""
    bands, rows = tuned()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, lines, row, number, sizes, values, bounds in _sets(batch):
                long = _long(lines)
                if not len(long):
                    continue
                own, ends = _chosen(values, bounds, long)
                registers = minhash(own, ends, bands * rows)
                keys = band_keys(registers, rows) & ((1 << KEY_BITS) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(row[long])),
                        pa.array(number[long], pa.int64()),
                        pa.array(sizes[long], pa.int64()),
                        pa.array(_items(own, ends), pa.int64()),
                        pa.array(np.diff(ends), pa.int64()),
                        ragged(keys.ravel(), np.arange(len(long) + 1) * bands, pa.int64()),
                        sketches(registers),
                    ],
                    ["doc_id", "line", "lines", "item", "size", "bands", "sketch"],
                )

    schema = "doc_id long, line long, lines long, item long, size long, bands array<long>, sketch binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _paragraph_texts(docs: DataFrame, known: Screen) -> DataFrame:
    """(item, text) of each paragraph whose item the screen lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lines, _, _, _, values, bounds in _sets(batch):
                long = _long(lines)
                items = _items(*_chosen(values, bounds, long))
                held = known.holds(items.view(U64))
                body = lines.data.tobytes()
                texts = [body[lines.starts[i] : lines.starts[i + 1]].decode() for i in long[held]]
                yield pa.RecordBatch.from_arrays([pa.array(items[held], pa.int64()), pa.array(texts, pa.string())], ["item", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, "item long, text string")


def _text_sets(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch["text"]):
                values, bounds = shingles(lower_case(part))
                yield pa.RecordBatch.from_arrays([batch["item"][part.first : part.last], ragged(values.view(np.int64), bounds, pa.int64())], ["item", "values"])

    return texts.mapInArrow(run, "item long, values array<long>")


def _order(within: str = "line") -> Column:
    """Place of a paragraph or window in the corpus: by id, rows without one first, then by line or start."""
    wide = F.coalesce("doc_id", F.lit(-(1 << 63))).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)")
    return (wide + F.col(within)).cast("decimal(32,0)")


def repeated_paragraphs(docs: DataFrame, work: Workspace) -> DataFrame:
    """(doc_id, line, lines, root) of each paragraph, and whether it is ``removed``.

    A paragraph is a line of 25 words or more, or neighbouring shorter lines, up
    to a blank or a long one, that have as many together; ``line`` is its first.
    Its set holds its distinct
    five-word shingles, lower-cased (A-Z). Paragraphs whose sets have a Jaccard
    similarity of 0.75 or more are linked; of each component of links the first
    paragraph, by doc_id and line, stays and the others are removed. Equal sets
    take part once, however many lines have them. Rows without an id come first
    in the order and are one document together; null and empty texts have no
    paragraphs; of repeated rows of one id, equal lines count as one place, so a
    document never removes its own first copy.
    """
    grouping = work.inner("grouping")
    signed = grouping.store(signed_paragraphs(docs), "paragraphs")
    # Signatures are much larger than places, and go as soon as the buckets are known.
    places = grouping.store(signed.select("doc_id", "line", "lines", "item"), "places")

    def sets_of(ids: DataFrame) -> DataFrame:
        # Most paragraphs share no bucket; the screen keeps their texts out of the shuffle.
        found = _paragraph_texts(docs, screen(ids.select(F.col("item").alias("print")))).join(ids, "item")
        return _text_sets(found.groupBy("item").agg(F.min("text").alias("text")))

    roots, _ = groups(signed.select("item", "size", "bands", "sketch"), sets_of, grouping, once=True, spent=("paragraphs",))
    placed = places.select("doc_id", "line", "lines", "item", _order().alias("place"))
    rooted = placed.join(roots.selectExpr("node AS item", "root"), "item", "left").withColumn("root", F.coalesce("root", "item"))
    rooted = work.store(rooted.drop("item"), "rooted")
    work.drop("grouping")
    first = rooted.groupBy("root").agg(F.min("place").alias("first"))
    return rooted.join(first, "root").select("doc_id", "line", "lines", "root", F.expr("place > first").alias("removed"))


def repeated_passages(docs: DataFrame, work: Workspace, marked: DataFrame | None = None) -> DataFrame:
    """(doc_id, passages): per document, the character spans of words that stand in an earlier window too.

    A window is 25 words in a row, lower-cased (A-Z), wherever lines break; equal
    windows have similarity 1. The first of equal ones, by doc_id and start,
    stays whole, the words of the others go, so of 50 equal words or more in a
    row at least 25 are found. Windows that differ in a word are not compared:
    one changed word inside leaves two windows a similarity of 16 / 26. Ids are
    treated as for paragraphs.

    ``marked`` are the paragraphs of ``repeated_paragraphs``. A window that touches
    a removed line is never the first of its kind, so what goes as a passage still
    stands in a line that stays.
    """
    every = work.store(windows(docs), "windows")
    often = every.groupBy("window").agg(F.count("*").alias("n")).where("n > 1")
    made = work.store(every.join(often.select("window"), "window"), "shared-windows").withColumn("place", _order("start"))
    work.drop("windows")
    staying = made
    if marked is not None:
        gone = marked.where("removed").select(F.col("doc_id").alias("_id"), F.explode(F.expr("sequence(line, line + lines - 1)")).alias("_line")).distinct()
        each = made.select("doc_id", "place", F.explode(F.expr("sequence(line, last_line)")).alias("line"))
        lost = each.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("line") == F.col("_line")), "left_semi")
        staying = made.join(lost.select("place"), "place", "left_anti")
    first = staying.groupBy("window").agg(
        F.min("place").alias("first"), F.max("place").alias("last"), F.min_by(F.col("end") - F.col("start"), F.col("place")).alias("length")
    )
    first = work.store(first.where("first < last").drop("last"), "repeated-windows")
    # What overlaps the first window begins behind it.
    begin = "start + CAST(greatest(first + length - place, 0) AS BIGINT)"
    again = made.join(first, "window").where("place > first").select("doc_id", F.expr(f"struct({begin} AS start, end)").alias("span"))
    listed = again.where("span.start < span.end").groupBy("doc_id").agg(F.array_sort(F.collect_set("span")).alias("spans"))
    kind = "array<struct<start: bigint, end: bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            unions = []
            for spans in batch["spans"].to_pylist():
                union: list[dict[str, int]] = []
                for x in spans:
                    if union and x["start"] <= union[-1]["end"]:
                        union[-1]["end"] = max(union[-1]["end"], x["end"])
                    else:
                        union.append(x)
                unions.append(union)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(unions, of)], ["doc_id", "passages"])

    return listed.mapInArrow(run, f"doc_id long, passages {kind}")


def removal_counts(docs: DataFrame, work: Workspace) -> DataFrame:
    """One row per document: doc_id, n_paragraphs, n_removed, the removed line numbers in order, and the removed passages.

    Passages are spans of characters of the text, in removed lines and in others.
    """
    marked = work.store(repeated_paragraphs(docs, work).distinct(), "marked")
    gone = F.expr("sequence(line, line + lines - 1)")
    per_doc = marked.groupBy(F.col("doc_id").alias("_id")).agg(
        F.count("*").alias("n_paragraphs"),
        F.count_if("removed").alias("n_removed"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("removed"), gone))))).alias("removed_lines"),
    )
    passages = repeated_passages(docs, work, marked).select(F.col("doc_id").alias("_own"), F.col("passages").alias("removed_passages"))
    joined = docs.select("doc_id").join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    joined = joined.join(passages, F.col("doc_id").eqNullSafe(F.col("_own")), "left")
    none = F.array().cast("array<long>")
    return joined.select(
        "doc_id",
        F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"),
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("removed_lines", none).alias("removed_lines"),
        F.coalesce("removed_passages", F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("removed_passages"),
    )


def without_repeats(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``docs`` with the removed lines and passages taken out of the texts; ``counts`` comes from ``removal_counts``.

    Line breaks inside a passage stay unless their line is removed. Of rows
    without an id only lines are taken out, as they share one list of passages.
    """
    gone = counts.select(F.col("doc_id").alias("_id"), "removed_lines", "removed_passages").distinct()
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    spans = "CASE WHEN doc_id IS NULL THEN array() ELSE coalesce(removed_passages, array()) END"
    cut = (
        f"aggregate({spans}, struct('' AS made, 0L AS at), (s, x) -> struct("
        "concat(s.made, substring(text, CAST(s.at + 1 AS INT), CAST(x.start - s.at AS INT)), "
        "regexp_replace(substring(text, CAST(x.start + 1 AS INT), CAST(x.end - x.start AS INT)), '[^\\n]+', '')) AS made, x.end AS at), "
        "s -> concat(s.made, substring(text, CAST(s.at + 1 AS INT))))"
    )
    rest = F.expr(f"array_join(filter(split({cut}, '\\n'), (x, i) -> NOT coalesce(array_contains(removed_lines, CAST(i AS BIGINT)), false)), '\\n')")
    return joined.select(*[rest.alias("text") if c == "text" else F.col(c) for c in docs.columns])
