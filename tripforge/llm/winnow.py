"""Benchmark decontamination by winnowing: least gram hashes of sliding windows meet, and hits are extended to windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripforge.llm import flat
from tripforge.llm.flat import U64
from tripforge.session import Workspace

WINDOW = 10  # words that an item and a document must share in a row
GRAM = 6  # words of a fingerprint: one of the five in every window is kept

#: Bits of the screen per fingerprint, and its limits (16 MB at most; a fuller screen only lets more through to the join).
BITS_PER_PRINT = 32
SCREEN_BITS = (20, 27)
#: Distinct benchmark windows that every executor may hold; beyond, the join shuffles.
MAX_BROADCAST = 200_000

_PIECE = "found array<struct<start:int,size:int,print:long,text:string>>"
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def words(part: flat.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row (within the slice) of each run of letters, digits and non-ASCII characters."""
    dark = _WORD[part.data]
    edge = np.zeros(len(part.data) + 1, bool)
    edge[part.starts] = True
    starts = np.flatnonzero(dark & (~np.concatenate(([False], dark[:-1])) | edge[:-1]))
    ends = np.flatnonzero(dark & (~np.concatenate((dark[1:], [False])) | edge[1:])) + 1
    return starts, ends, np.searchsorted(part.starts, starts, "right") - 1


def fingerprints(hashes: np.ndarray, owner: np.ndarray, size: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """First word of each window of ``size`` words inside one row, and the least hash of the window's grams.

    The choice depends on the window's words alone, so equal windows keep the same gram wherever they stand: every
    shared window meets. Windows no longer than a gram are a gram of their own.
    """
    gram = min(gram, size) if size >= WINDOW else size
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    joint = np.zeros(len(hashes) - gram + 1, U64)
    for place in range(gram):
        joint += hashes[place : place + len(joint)] * flat._PLACES[place]
    joint = flat.mixed(joint + U64(gram))
    least = joint[:count].copy()
    for step in range(1, size - gram + 1):
        np.minimum(least, joint[step : step + count], out=least)
    starts = np.flatnonzero(owner[size - 1 :] == owner[:count])
    return starts, least[starts]


class Screen:
    """A Bloom filter of fixed size over the benchmark's fingerprints; two places per fingerprint."""

    def __init__(self, bits: int, cells: np.ndarray):
        self.bits, self.cells = bits, cells

    def holds(self, prints: np.ndarray) -> np.ndarray:
        last = U64((1 << self.bits) - 1)
        held = np.ones(len(prints), bool)
        for place in (prints & last, (prints >> U64(64 - self.bits))):
            held &= (self.cells[place >> U64(6)] >> (place & U64(63))) & U64(1) == 1
        return held


def screen(prints: DataFrame) -> Screen:
    """A screen sized for the distinct ``print`` values; executors set the bits, the driver gets at most 16 MB of them."""
    known = prints.select("print").distinct()
    bits = int(min(max((known.count() * BITS_PER_PRINT).bit_length(), SCREEN_BITS[0]), SCREEN_BITS[1]))
    low = F.col("print").bitwiseAND(F.lit((1 << bits) - 1))
    high = F.shiftrightunsigned("print", 64 - bits)
    place = known.select(F.explode(F.array(low, high)).alias("place"))
    cell = F.expr("shiftleft(1L, CAST(place % 64 AS INT))")
    rows = place.groupBy(F.shiftright("place", 6).alias("cell")).agg(F.bit_or(cell).alias("set")).toArrow()
    cells = np.zeros(1 << (bits - 6), U64)
    cells[rows["cell"].to_numpy()] = rows["set"].to_numpy().view(U64)
    return Screen(bits, cells)


def _windows(part: flat.Slice, sizes: Sequence[int], known: Screen | None) -> tuple[np.ndarray, list[tuple]]:
    """Words of each row, and (row, start, size, print, text) of its windows that the screen lets through.

    Without a screen the slice holds benchmark items: an item shorter than a window is one window as it is.
    """
    starts, ends, owner = words(part)
    counts = np.bincount(owner, minlength=part.last - part.first)
    first = np.concatenate(([0], np.cumsum(counts)))
    hashes = flat.span_hashes(flat.prefix_sums(part.data), starts, ends)
    body, found = part.data.tobytes(), []
    for size in sizes:
        at, prints = fingerprints(hashes, owner, size)
        if known is not None:
            taken = known.holds(prints)
        else:
            taken = (counts[owner[at]] == size) | (size == WINDOW)
        for word, fingerprint in zip(at[taken].tolist(), prints[taken].view(np.int64).tolist(), strict=True):
            text = b" ".join(body[starts[i] : ends[i]] for i in range(word, word + size))
            row = int(owner[word])
            found.append((row, word - int(first[row]), size, fingerprint, text.decode()))
    found.sort(key=lambda x: x[0])
    return counts, found


def scanned(rows: DataFrame, key: str, kind: str, sizes: Sequence[int], known: Screen | None = None) -> DataFrame:
    """``key``, n_words and ``found`` windows (start, size, print, text) of every row's whole text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.slices(batch["text"]):
                counts, found = _windows(flat.lower_case(part), sizes, known)
                bounds = np.searchsorted(np.array([x[0] for x in found], np.int64), np.arange(len(counts) + 1))
                pieces = pa.StructArray.from_arrays(
                    [pa.array([x[i] for x in found], t) for i, t in ((1, pa.int32()), (2, pa.int32()), (3, pa.int64()), (4, pa.string()))],
                    ["start", "size", "print", "text"],
                )
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pieces)
                keys = batch[key].slice(part.first, part.last - part.first)
                yield pa.RecordBatch.from_arrays([keys, pa.array(counts.astype(np.int64)), lists], [key, "n_words", "found"])

    return rows.select(key, "text").mapInArrow(scan, f"{key} {kind}, n_words long, {_PIECE}")


def _set_key(member: Column) -> list[Column]:
    """Sums that tell sets of distinct members apart by 128 hashed bits; they add up without gathering the set."""
    hashes = [F.sum(F.xxhash64(member, F.lit(seed)).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    return [F.concat_ws("/", F.count("*").cast("string"), *hashes)]


def _covered(spans: str) -> Column:
    """Words under a row's sorted spans, overlaps counted once."""
    return F.expr(
        f"aggregate({spans}, named_struct('reach', 0, 'n', 0L), (a, s) -> named_struct("
        "'reach', greatest(a.reach, s.end), 'n', a.n + greatest(0, s.end - greatest(a.reach, s.start))), a -> a.n)"
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, work: Workspace) -> DataFrame:
    """Words of each document that lie in a window of ten words shared with a benchmark item, and which items.

    Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. An item of one to nine words is one
    window of its own length. Returns one row per document: doc_id, n_words, n_hit, n_items, items_sha256 and
    contaminated.

    A null text has no words. Repeated rows and ids are judged each on its own; a null doc_id is carried as it is.
    Items that share an id count as one, items without an id as one whose id is the empty string. An empty benchmark,
    or one without words, hits nothing; an empty table gives no rows. Other columns are ignored.
    """
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    windows = scanned(named, "item", "string", range(1, WINDOW + 1)).select("item", F.inline("found"))
    windows = work.store(windows.select("item", "size", "print", "text").distinct(), "windows")
    sizes = sorted(r.size for r in windows.select("size").distinct().collect())

    # Windows that stand in the same items form one class, so a passage that many items share is joined once.
    kinds = work.store(windows.groupBy("size", "print", "text").agg(*[c.alias("items") for c in _set_key(F.col("item"))]), "kinds")
    heads = kinds.dropDuplicates(["items"])
    sets = work.store(heads.join(windows, ["size", "print", "text"]).select("items", "item"), "sets")

    found = scanned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", "long", sizes, screen(windows))
    found = work.store(found.withColumn("row", F.monotonically_increasing_id()), "found")
    known = F.broadcast(kinds) if kinds.count() <= MAX_BROADCAST else kinds
    candidates = found.select("row", F.inline("found"))
    hits = work.store(candidates.join(known, ["size", "print", "text"]).select("row", "start", "size", "items"), "hits")

    span = F.struct("start", (F.col("start") + F.col("size")).alias("end"))
    words_hit = hits.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans")).select("row", _covered("spans").alias("n_hit"))
    pairs = hits.select("row", "items").distinct()
    mixes = pairs.groupBy("row").agg(*[c.alias("mix") for c in _set_key(F.col("items"))])
    rows = work.store(words_hit.join(mixes, "row"), "rows")
    first = rows.groupBy("mix").agg(F.min("row").alias("row"))
    members = first.join(pairs, "row").join(sets, "items").groupBy("mix").agg(F.array_sort(F.collect_set("item")).alias("ids"))
    named_items = work.store(
        members.select("mix", F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")), "mixes"
    )
    judged = rows.join(named_items, "mix").select("row", "n_hit", "n_items", "items_sha256")
    return (
        found.select("row", "doc_id", "n_words")
        .join(judged, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )
