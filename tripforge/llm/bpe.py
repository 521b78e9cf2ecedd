"""Byte-level BPE by rank files: whole pre-tokens by a perfect hash, the others by a heap over linked bytes."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tripforge.llm import perfect
from tripforge.llm.flat import slices

#: Encoded chunks, and pre-tokens, that a task remembers before it starts afresh; bounds memory, changes no result.
REMEMBERED = 400_000
#: Characters of the longest chunk or pre-token that is remembered, so that the bound above also bounds bytes.
LONGEST = 64
#: Bytes of texts whose distinct pre-tokens are looked up together.
TEXTS_TOGETHER = 1 << 21
#: Bytes of pre-tokens whose lists and heaps are laid out together; one longer pre-token is laid out alone.
MERGED_TOGETHER = 1 << 17

# The characters of the Unicode property White_Space.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space and what follows it. A pre-token pattern may be applied to each chunk by itself as long as none of its
#: matches holds white space after another character and it never looks behind, which holds for the public patterns.
CHUNK = f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+"


@dataclass
class Vocabulary:
    """Token bytes by rank, a perfect hash over them, and the pre-token pattern. Small enough to send to each task."""

    pattern: str
    tokens: list[bytes]
    numbers: perfect.PerfectHash
    rank_of_number: np.ndarray
    _ranks: dict[bytes, int] | None = field(default=None, repr=False)
    _decimals: list[str] | None = field(default=None, repr=False)
    _short: tuple[np.ndarray, np.ndarray] | None = field(default=None, repr=False)
    #: Ids of chunks and of pre-tokens as 32-bit integers: smaller than lists, and nothing for the garbage collector to visit.
    chunks: dict[str, bytes] = field(default_factory=dict, repr=False)
    pieces: dict[str, bytes] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_ranks": None, "_decimals": None, "_short": None, "chunks": {}, "pieces": {}}

    @property
    def decimals(self) -> list[str]:
        if self._decimals is None:
            self._decimals = [str(rank) for rank in range(len(self.tokens))]
        return self._decimals

    @property
    def ranks(self) -> dict[bytes, int]:
        if self._ranks is None:
            self._ranks = {token: rank for rank, token in enumerate(self.tokens) if token}
        return self._ranks

    @property
    def short(self) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of single bytes, and of pairs of bytes by ``256 * first + second``; -1 where it is no token."""
        if self._short is None:
            ones, twos = np.full(1 << 8, -1, np.int64), np.full(1 << 16, -1, np.int64)
            for token, rank in self.ranks.items():
                if len(token) <= 2:
                    (ones if len(token) == 1 else twos)[int.from_bytes(token)] = rank
            self._short = ones, twos
        return self._short

    def merge(self, pieces: list[bytes]) -> Iterator[list[int]]:
        """Ranks of pre-tokens that are no tokens themselves.

        Bytes form a linked list. A piece's heap holds the rank of each
        neighbouring pair that is a token, with its place; the least rank,
        leftmost first, merges next, and entries whose pair has changed are
        passed over.
        """
        sizes = np.array([len(piece) for piece in pieces], np.int64)
        part = (np.cumsum(sizes) - sizes) // MERGED_TOGETHER
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(pieces)]
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            if first < last:
                yield from self._merge_together(pieces[first:last], sizes[first:last])

    def _merge_together(self, pieces: list[bytes], sizes: np.ndarray) -> Iterator[list[int]]:
        """The lists and heaps of all pieces are laid out at once."""
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        until = np.cumsum(sizes)
        ones, twos = self.short
        single, paired = ones[data], np.full(len(data), -1, np.int64)
        if single.min() < 0:
            raise ValueError("a byte of the texts is no token")
        paired[:-1] = twos[data[:-1] << 8 | data[1:]]
        paired[until - 1] = -1
        most = int(sizes.max())
        bits = most.bit_length()
        mask = (1 << bits) - 1
        owner = np.repeat(np.arange(len(pieces)), sizes)
        place = np.arange(len(data)) - (until - sizes)[owner]
        entries = np.where(paired >= 0, paired << bits | place, -1)
        held = np.flatnonzero(paired >= 0)
        # In order, a piece's entries are a heap already.
        heaps = entries[held[np.lexsort((entries[held], owner[held]))]].tolist()
        bounds = np.searchsorted(owner[held], np.arange(len(pieces) + 1)).tolist()
        flat_pairs, flat_ranks = entries.tolist(), single.tolist()
        next_places, last_places = list(range(1, most + 1)), list(range(-1, most - 1))
        del data, single, paired, owner, place, entries, held
        rank_of, pop, push, at = self.ranks.get, heapq.heappop, heapq.heappush, 0
        for number, piece in enumerate(pieces):
            size = len(piece)
            pairs, made = flat_pairs[at : at + size], flat_ranks[at : at + size]
            heap = heaps[bounds[number] : bounds[number + 1]]
            ends, before = next_places[:size], last_places[:size]  # part i is piece[i:ends[i]], and the next one starts at ends[i]
            at += size
            while heap:
                entry = pop(heap)
                i = entry & mask
                if pairs[i] != entry:
                    continue
                made[i] = entry >> bits
                gone = ends[i]
                end = ends[i] = ends[gone]
                pairs[gone] = made[gone] = pairs[i] = -1
                if end < size:
                    before[end] = i
                    rank = rank_of(piece[i : ends[end]])
                    if rank is not None:
                        pairs[i] = rank << bits | i
                        push(heap, pairs[i])
                last = before[i]
                if last >= 0:
                    pairs[last] = -1
                    rank = rank_of(piece[last:end])
                    if rank is not None:
                        pairs[last] = rank << bits | last
                        push(heap, pairs[last])
            yield [rank for rank in made if rank >= 0]


def load(path: str, pattern: str) -> Vocabulary:
    """Read a rank file (base64 of the token's bytes, then its rank) on the driver."""
    tokens: list[bytes] = []
    with open(path, "rb") as lines:
        for line in lines:
            token, rank = line.split()
            tokens += [b""] * (int(rank) + 1 - len(tokens))
            tokens[int(rank)] = base64.b64decode(token)
    held = np.array([rank for rank, token in enumerate(tokens) if token])
    keys = perfect.hashes(pa.array([tokens[i] for i in held], pa.large_binary()))
    numbers = perfect.build(keys)
    rank_of_number = np.zeros(len(held), np.int64)
    rank_of_number[numbers.numbers(keys)] = held
    return Vocabulary(pattern, tokens, numbers, rank_of_number)


def encode(texts: list[str], vocabulary: Vocabulary, split: regex.Pattern) -> list[list[int]]:
    """Token ids of whole texts."""
    return [np.frombuffer(ids, np.int32).tolist() for ids in packed(texts, vocabulary, split)]


def packed(texts: list[str], vocabulary: Vocabulary, split: regex.Pattern) -> list[bytes]:
    """Token ids of whole texts, each text's as 32-bit integers.

    Chunks that the task hasn't met are split into pre-tokens. Of those it hasn't
    met either, the perfect hash finds the ones that are tokens, all at once; the
    others are merged.
    """
    cut, known, ids_of = re.compile(CHUNK), vocabulary.chunks, vocabulary.pieces
    for memory in (known, ids_of):
        if len(memory) >= REMEMBERED:
            memory.clear()
    parts = [cut.findall(text) for text in texts]
    fresh: set[str] = set()
    for chunks in parts:
        fresh.update(chunks)
    new = list(fresh.difference(known))
    pieces = [split.findall(chunk) for chunk in new]
    names = list({piece for own in pieces for piece in own}.difference(ids_of))
    raw = [piece.encode() for piece in names]
    found = vocabulary.numbers.numbers(perfect.hashes(pa.array(raw, pa.large_binary()))) if raw else np.zeros(0, np.int64)
    ranks = np.where(found >= 0, vocabulary.rank_of_number[found], -1).tolist()
    tokens = vocabulary.tokens
    whole = [rank >= 0 and tokens[rank] == piece for piece, rank in zip(raw, ranks, strict=True)]
    merged = vocabulary.merge([piece for piece, held in zip(raw, whole, strict=True) if not held])
    for name, rank, held in zip(names, ranks, whole, strict=True):
        ids_of[name] = array("i", (rank,) if held else next(merged)).tobytes()
    for chunk, own in zip(new, pieces, strict=True):
        known[chunk] = ids_of[own[0]] if len(own) == 1 else b"".join([ids_of[piece] for piece in own])
    out = [b"".join(map(known.__getitem__, chunks)) for chunks in parts]
    for memory, met in ((known, new), (ids_of, names)):
        for text in [text for text in met if len(text) > LONGEST]:
            del memory[text]
    return out


def decode(ids: list[int], vocabulary: Vocabulary) -> bytes:
    return b"".join(map(vocabulary.tokens.__getitem__, ids))


def split_texts(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """First row, last row and texts of bounded slices of a batch's column; null counts as empty."""
    for part in slices(column, TEXTS_TOGETHER):
        body = part.data.tobytes()
        yield part.first, part.last, [body[a:b].decode() for a, b in zip(part.starts[:-1], part.starts[1:], strict=True)]


def encoded(docs: DataFrame, vocabulary: Vocabulary, keep_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, digests of the ids and of the decoded bytes, and the ids if asked for.

    Whole texts are encoded without special tokens; null counts as empty and has
    no tokens. Decoding the ids gives back the text's bytes, which is checked.
    Other columns are ignored and repeated rows are encoded alike. Rows need no
    shuffle; the vocabulary, whose size doesn't depend on the texts, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        split = regex.compile(words.pattern)
        for batch in batches:
            for first, last, texts in split_texts(batch["text"]):
                yield _rows(batch["doc_id"][first:last], texts, words, split, keep_ids)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _rows(ids: pa.Array, texts: list[str], words: Vocabulary, split: regex.Pattern, keep_ids: bool) -> pa.RecordBatch:
    out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
    for text, tokens in zip(texts, encode(texts, words, split), strict=True):
        body = decode(tokens, words)
        if body != text.encode():
            raise ValueError("decoding the ids does not give back the text")
        out["n_tokens"].append(len(tokens))
        out["ids_sha256"].append(hashlib.sha256(",".join(map(words.decimals.__getitem__, tokens)).encode()).hexdigest())
        out["decoded_sha256"].append(hashlib.sha256(body).hexdigest())
        if keep_ids:
            out["ids"].append(tokens)
    arrays = [ids.cast(pa.int64()), pa.array(out["n_tokens"], pa.int64()), pa.array(out["ids_sha256"], pa.string()), pa.array(out["decoded_sha256"], pa.string())]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if keep_ids:
        arrays, names = [*arrays, pa.array(out["ids"], pa.list_(pa.int32()))], [*names, "ids"]
    return pa.RecordBatch.from_arrays(arrays, names)
