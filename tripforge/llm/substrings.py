"""Suffix-array dedup: remove bytes of long strings that also occur earlier in the corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.flat import U64, Slice, prefix_sums, slices, span_hashes
from tripforge.llm.suffixes import equal_runs, suffix_array
from tripforge.session import Workspace

#: Bytes of a string that counts as repeated.
LENGTH = 100
#: Bytes of the grams among which each string has an anchor.
GRAM = 24
#: Bytes of contexts that are suffix-sorted together.
BLOCK_BYTES = 1 << 20
#: Occurrences of a gram that one block compares; those of a commoner gram are dealt over several parts.
TOGETHER = BLOCK_BYTES // (LENGTH + GRAM)
#: Neighbouring starts that a very common gram's contexts are cut into; all their strings share their other bytes.
NARROW = 8

_PLACE_BITS = U64(24)
_NO_ID = -(1 << 63)


def anchors(part: Slice, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchors of the strings of ``length`` bytes of each row: (row, gram, place, first, last, context).

    A string's anchor is its gram of the least hash, the leftmost of several, so
    equal strings have equal anchors at equal distances from their starts.
    Strings starting at ``first`` to ``last`` of a row share the anchor at
    ``place``; all are offsets in bytes from the row's start. ``context`` is a
    hash of the bytes that these strings cover.
    """
    span, size = length - GRAM + 1, len(part.data)
    none = np.zeros(0, np.int64)
    if size < length:
        return none, np.zeros(0, U64), none, none, none, np.zeros(0, U64)
    sums = prefix_sums(part.data)
    starts = np.arange(size - GRAM + 1)
    grams = span_hashes(sums, starts, starts + GRAM)
    # High bits of the hash, then the place: the least of a window is its anchor.
    keys = (grams >> _PLACE_BITS) << _PLACE_BITS | starts.astype(U64)
    width, least = 1, keys
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    places = (least & ((U64(1) << _PLACE_BITS) - U64(1))).astype(np.int64)
    row = np.searchsorted(part.starts, np.arange(len(places)), "right") - 1
    whole = np.arange(len(places)) + length <= part.starts[row + 1]
    fresh = np.ones(len(places), bool)
    fresh[1:] = (places[1:] != places[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh & whole)
    change = np.append(np.flatnonzero(fresh | ~whole), len(places))
    last = change[np.searchsorted(change, first, "right")] - 1
    own = row[first]
    base = part.starts[own]
    around = span_hashes(sums, first, last + length)
    return own, grams[places[first]], places[first] - base, first - base, last - base, around


def _narrow(part: Slice, length: int) -> Iterator[tuple[int, Slice, int]]:
    """Pieces of a slice whose places fit the key: (first row, piece, offset of the piece in its row).

    Only a text longer than the key's places is cut; its pieces overlap, so that every string lies in one.
    """
    most = 1 << int(_PLACE_BITS)
    if len(part.data) <= most:
        yield 0, part, 0
        return
    for row, (a, b) in enumerate(zip(part.starts[:-1], part.starts[1:], strict=True)):
        step = most - length + 1
        for start in range(a, max(b - length + 1, a + 1), step):
            end = min(start + most, b)
            yield row, Slice(0, 1, part.data[start:end], np.array([0, end - start])), int(start - a)


def _packed(first: np.ndarray, last: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Starts and anchor of a row of strings as one number that orders by ``first``."""
    return first << 16 | (last - first) << 8 | (place - first)


def _unpacked(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of starts, and bytes from the first start to the anchor."""
    return packed >> 16, (packed >> 8 & 0xFF) + 1, packed & 0xFF


def _keyed(docs: DataFrame) -> DataFrame:
    """``id`` is the document's id, rows without one coming first."""
    return docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "text")


def _all_anchors(docs: DataFrame, length: int, grams_only: bool) -> DataFrame:
    names = ["gram"] if grams_only else ["gram", "id", "packed", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch["text"]):
                for at, piece, offset in _narrow(part, length):
                    row, gram, place, first, last, context = anchors(piece, length)
                    columns = [pa.array(gram.view(np.int64))]
                    if not grams_only:
                        packed = _packed(first + offset, last + offset, place + offset)
                        columns += [batch["id"].take(pa.array(row + at + part.first)), pa.array(packed), pa.array(context.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return _keyed(docs).mapInArrow(run, ", ".join(f"{name} long" for name in names))


def _compressed(docs: DataFrame) -> DataFrame:
    """Ids and compressed texts, which are what later steps shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in slices(batch["text"]):
                body = part.data.tobytes()
                texts = [pack(body[a:b]) for a, b in zip(part.starts[:-1], part.starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch["id"][part.first : part.last], pa.array(texts, pa.binary())], ["id", "body"])

    return _keyed(docs).mapInArrow(run, "id long, body binary")


def _whole_groups(batches: Iterator[pa.RecordBatch], least: Callable[[pa.Table], bool]) -> Iterator[pa.Table]:
    """Rows sorted by ``gram`` and ``part``, as tables that hold whole groups and satisfy ``least``, the last one aside."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 5_000):
            held.append(batch.slice(at, 5_000))
            table = pa.Table.from_batches(held)
            if not least(table):
                continue
            gram, part = table["gram"].to_numpy(), table["part"].to_numpy()
            # The last group may go on in the next batch.
            done = int(np.count_nonzero((gram != gram[-1]) | (part != part[-1])))
            if done:
                yield table.slice(0, done)
                held = table.slice(done).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


_JUDGED = "gram long, parts int, id long, packed long, repeated boolean"


def _judged(rows: DataFrame) -> DataFrame:
    """Compare anchors of one gram by their contexts' hashes.

    ``repeated`` rows have the same context as an earlier one, so all their
    strings are repeated. Of the others, those stay whose gram has another
    context, here or in another part: some of their strings may be repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, lambda x: x.num_rows >= 100_000):
            c = {name: table[name].to_numpy() for name in table.column_names}
            before = c["packed"] & 0xFFFF
            order = np.lexsort((c["packed"], c["id"], before, c["context"], c["part"], c["gram"]))
            c = {name: values[order] for name, values in c.items()}
            before = before[order]
            group, same = np.zeros(len(order), bool), np.zeros(len(order), bool)
            group[1:] = (c["gram"][1:] == c["gram"][:-1]) & (c["part"][1:] == c["part"][:-1])
            same[1:] = group[1:] & (c["context"][1:] == c["context"][:-1]) & (before[1:] == before[:-1])
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
            # A row that repeats a document is not later than itself.
            repeated = (c["id"] != c["id"][head]) | (c["packed"] != c["packed"][head])
            number = np.cumsum(~group) - 1
            classes = np.bincount(number, weights=~same)[number]
            chosen = repeated | (~same & ((classes > 1) | (c["parts"] > 1)))
            own = [pa.array(c[name][chosen]) for name in ("gram", "parts", "id", "packed")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(repeated[chosen])], [x.split()[0] for x in _JUDGED.split(", ")])

    return rows.mapInArrow(run, _JUDGED)


_CONTEXT = "gram long, parts int, id long, packed long, context binary"


def _narrowed(first: np.ndarray, starts: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts cut where the distance to the anchor is a multiple of ``NARROW``: (row, first, starts, before, distance // NARROW)."""
    low, high = (before - starts + 1) // NARROW, before // NARROW
    counts = high - low + 1
    row = np.repeat(np.arange(len(first)), counts)
    block = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    far = np.minimum(before[row], block * NARROW + NARROW - 1)
    near = np.maximum((before - starts + 1)[row], block * NARROW)
    return row, (first + before)[row] - far, far - near + 1, far, block


def _contexts(rows: DataFrame, length: int) -> DataFrame:
    """The bytes that the strings of each anchor cover, from a document's list of anchors and its text.

    Those of a gram of several parts are cut into narrow ones, whose ``gram`` is
    a hash of the bytes that all strings of a block of distances would share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            lists = batch["anchors"]
            flat = lists.flatten()
            counts = np.diff(np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1])
            gram, parts = (flat.field(name).to_numpy() for name in ("gram", "parts"))
            first, starts, before = _unpacked(flat.field("packed").to_numpy())
            common, row = np.flatnonzero(parts > 1), np.arange(len(gram))
            block = np.full(len(gram), -1)
            if len(common):
                single = np.flatnonzero(parts <= 1)
                own, *cut, number = _narrowed(first[common], starts[common], before[common])
                row, block = np.concatenate((single, common[own])), np.concatenate((block[single], number))
                first, starts, before = (np.concatenate((x[single], y)) for x, y in zip((first, starts, before), cut, strict=True))
                order = np.argsort(row, kind="stable")
                row, block, first, starts, before = (x[order] for x in (row, block, first, starts, before))
            gram, parts, ends = gram[row], parts[row], first + starts - 1 + length
            doc = np.repeat(np.arange(len(lists)), counts)[row]
            spans = zip(first.tolist(), ends.tolist(), strict=True)
            bodies, texts = [], []
            for body, count in zip(batch["body"], np.bincount(doc, minlength=len(lists)).tolist(), strict=True):
                text = unpack(body.as_py())
                texts.append(text)
                bodies += [text[a:b] for a, b in islice(spans, count)]
            for i in np.flatnonzero(block >= 0).tolist():
                begin = int(first[i] + before[i] - block[i] * NARROW)
                shared = texts[doc[i]][begin : begin + length - NARROW + 1]
                gram[i] = np.uint64(xxhash.xxh3_64_intdigest(shared, seed=int(block[i]))).astype(np.int64)
            which = batch["id"].take(pa.array(doc))
            packed = _packed(first, first + starts - 1, first + before)
            made = pa.RecordBatch.from_arrays(
                [pa.array(gram), pa.array(parts), which, pa.array(packed), pa.array(bodies, pa.binary())], [x.split()[0] for x in _CONTEXT.split(", ")]
            )
            # An id that repeats with another text gives contexts that are cut short.
            yield made.filter(pa.array(np.array([len(x) for x in bodies], np.int64) == ends - first))

    return rows.mapInArrow(run, _CONTEXT)


def _dealt(contexts: DataFrame) -> DataFrame:
    """Contexts with the ``part`` of their gram that compares them. Narrow ones that share their gram with no other are unique."""
    common = contexts.where("parts > 1").drop("parts")
    counted = common.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    common = common.join(counted.select("gram", F.expr(f"CAST(ceil(n / {TOGETHER}) AS INT) AS parts")), "gram")
    every = contexts.where("parts = 1").unionByName(common)
    return every.withColumn("part", F.expr("CAST(pmod(xxhash64(id, packed), parts) AS INT)")).repartition("gram", "part")


_FOUND = "id long, first long, last long, gram long, string long"


def _compared(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated strings among the contexts of each gram.

    Rows with a null ``string`` are starts that occur earlier for certain.
    Others are the earliest of their gram's part, to be compared between parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, lambda x: x["context"].nbytes >= BLOCK_BYTES):
            yield from _block(table, length)

    return contexts.mapInArrow(run, _FOUND)


def _block(table: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    ids, packed = table["id"].to_numpy(), table["packed"].to_numpy()
    order = np.lexsort((packed, ids))
    table = table.take(pa.array(order)).combine_chunks()
    ids, gram, parts = (table[name].to_numpy() for name in ("id", "gram", "parts"))
    first, count, _ = _unpacked(packed[order])
    bodies = table["context"].to_pylist()
    text = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.array([len(x) for x in bodies])
    begins = np.cumsum(sizes) - sizes
    context = np.repeat(np.arange(len(bodies)), sizes)
    offset = np.arange(len(text)) - begins[context]
    suffixes = suffix_array(text, length)
    group = np.empty(len(text), np.int64)
    group[suffixes] = equal_runs(text, suffixes, length)
    places = np.flatnonzero(offset < count[context])
    # Contexts are in the order of the corpus, so the least place of a group is its earliest string.
    earliest = np.full(group.max() + 1, len(text), np.int64)
    np.minimum.at(earliest, group[places], places)
    at = first[context] + offset
    lead = earliest[group[places]]
    repeated = (ids[context[places]] != ids[context[lead]]) | (at[places] != at[lead])

    def rows(low: np.ndarray, high: np.ndarray, strings: pa.Array) -> pa.RecordBatch:
        own = context[low]
        arrays = [pa.array(ids[own]), pa.array(at[low]), pa.array(at[high]), pa.array(gram[own]), strings]
        return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in _FOUND.split(", ")])

    again = places[repeated]
    cut = np.ones(len(again), bool)
    cut[1:] = (again[1:] != again[:-1] + 1) | (context[again[1:]] != context[again[:-1]])
    starts = np.flatnonzero(cut)
    if len(starts):
        yield rows(again[starts], again[np.append(starts[1:], len(again)) - 1], pa.nulls(len(starts), pa.int64()))
    open_ = places[~repeated & (parts[context[places]] > 1)]
    if len(open_):
        digests = span_hashes(prefix_sums(text), open_, open_ + length).view(np.int64)
        yield rows(open_, open_, pa.array(digests))


def repeated_starts(docs: DataFrame, work: Workspace, length: int = LENGTH) -> DataFrame:
    """(id, first, last): starts of strings of ``length`` bytes that occur earlier, as ranges.

    Each string has an anchor, a gram that depends on the string alone. Strings
    whose anchors' grams occur once in the corpus are unique, and most of the
    text leaves here. Anchors of one gram whose contexts are equal throughout
    need only their order. For what is left, the bytes of the contexts meet by
    gram, and suffix arrays over blocks of them find the equal strings. Contexts
    of a very common gram are first cut into a few starts each, which meet by
    the bytes that these have in common instead. Where even those bytes are very
    common, their occurrences are dealt over several parts; the earliest string
    of each part then meets those of the other parts by digest.
    """
    counted = _all_anchors(docs, length, grams_only=True).groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    counted = work.store(counted.select("gram", F.expr(f"CAST(ceil(n / {TOGETHER}) AS INT) AS parts")), "grams")
    shared = _all_anchors(docs, length, grams_only=False).join(counted, "gram")
    shared = shared.withColumn("part", F.expr("CAST(pmod(xxhash64(id, packed), parts) AS INT)")).repartition("gram", "part")
    judged = work.store(_judged(shared.sortWithinPartitions("gram", "part")), "judged")
    per_doc = judged.where("NOT repeated").groupBy("id").agg(F.collect_list(F.struct("gram", "parts", "packed")).alias("anchors"))
    texts = per_doc.join(_compressed(docs), "id").select("id", "anchors", "body")
    dealt = _dealt(work.store(_contexts(texts, length), "contexts")).sortWithinPartitions("gram", "part")
    found = work.store(_compared(dealt, length), "found")
    work.drop("contexts")
    place = (F.col("id").cast("decimal(20,0)") * F.lit(1 << 48).cast("decimal(17,0)") + F.col("first")).cast("decimal(38,0)")
    open_ = found.where("string IS NOT NULL").select("id", "first", "gram", "string", place.alias("place"))
    least = open_.groupBy("gram", "string").agg(F.min("place").alias("least"))
    across = open_.join(least, ["gram", "string"]).where("place > least").selectExpr("id", "first", "first AS last")
    same = judged.where("repeated").selectExpr("id", "shiftright(packed, 16) AS first", "shiftright(packed, 16) + (shiftright(packed, 8) & 255) AS last")
    return same.union(found.where("string IS NULL").select("id", "first", "last")).union(across)


def _merged(spans: list[dict], length: int, size: int) -> list[tuple[int, int]]:
    """Byte runs that strings starting in the given ranges cover."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((x["first"], min(x["last"] + length, size)) for x in spans if x["first"] < size):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def removed_substrings(docs: DataFrame, work: Workspace, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for.

    Texts are UTF-8 bytes, a null one being empty. A byte goes if a string of
    ``length`` bytes covers it that also starts earlier: in a document with a
    smaller id, or earlier in the same one; strings may overlap and never cross
    documents. Rows without an id count as one that is smaller than all others.
    Repeated rows of an id are one document, whose first bytes they all keep; an
    id should not repeat with different texts, which then share their removals. Shorter
    texts lose nothing. Other columns are ignored. Kept bytes need not be valid
    UTF-8, as a run may end inside a character.
    """
    starts = repeated_starts(docs, work, length)
    per_doc = starts.groupBy("id").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    joined = _compressed(docs).join(per_doc, "id", "left").select("id", "body", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for row in zip(batch["id"].to_pylist(), batch["body"], batch["spans"].to_pylist(), strict=True):
                text = unpack(row[1].as_py())
                gone = _merged(row[2] or [], length, len(text))
                edges = [0, *[edge for span in gone for edge in span], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                values = (None if row[0] == _NO_ID else row[0], len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept)
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            arrays = [pa.array(values, kind) for values, kind in zip(out.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays[: 5 + keep_text], list(out)[: 5 + keep_text])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    return joined.mapInArrow(run, schema)
