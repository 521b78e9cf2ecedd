"""Token counts of sections: encode a document once, then attribute its tokens by their character spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tripforge.llm.bpe import Vocabulary, packed, split_texts

SECTIONS = "doc_id long, section long, start_char long, end_char long, n_tokens long, n_crossing long"


def attribute(first: np.ndarray, last: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary.

    Both sides are ordered, so the interval join is a search. The rule: a token
    goes to the section that holds most of its characters, the earliest of them
    if several hold as many.
    """
    low = np.searchsorted(starts, first, "right") - 1
    high = np.searchsorted(starts, last - 1, "right") - 1
    owner = low.copy()
    ends = np.append(starts[1:], size)
    two = np.flatnonzero(high == low + 1)
    owner[two] += last[two] - starts[high[two]] > ends[low[two]] - first[two]
    for token in np.flatnonzero(high > low + 1):
        held = np.minimum(ends[low[token] : high[token] + 1], last[token]) - np.maximum(starts[low[token] : high[token] + 1], first[token])
        owner[token] += int(held.argmax())
    return owner, high > low


def section_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per line of each document: doc_id, section, character span, its tokens, and how many of them cross.

    Tokens are those of the whole document, so a document's sections add up to
    its count; ``n_crossing`` tells how many tokens the rule gave to the section
    although another holds part of them. A null or empty text has one empty
    section. Other columns are ignored, repeated rows are counted alike, and
    nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        split = regex.compile(words.pattern)
        sizes = np.array([len(x) for x in words.tokens], np.int64)
        for batch in batches:
            for first, last, texts in split_texts(batch["text"]):
                yield _sections(batch["doc_id"][first:last], texts, words, split, sizes)

    return docs.select("doc_id", "text").mapInArrow(run, SECTIONS)


def _sections(ids: pa.Array, texts: list[str], words: Vocabulary, split: regex.Pattern, sizes: np.ndarray) -> pa.RecordBatch:
    """Sections of a slice of texts, all laid end to end: no token and no section reaches over the end of a text.

    A token that holds part of a character's bytes spans that whole character.
    """
    tokens = np.frombuffer(b"".join(packed(texts, words, split)), np.int32).astype(np.int64)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    char_of = np.cumsum((data & 0xC0) != 0x80) - 1
    total = int(char_of[-1]) + 1 if len(data) else 0
    lengths = sizes[tokens]
    until = np.cumsum(lengths)
    # A line break belongs to the line it ends, and a text has one line at least: one that ends in a break has an empty
    # line after it, at the place where the next text starts. Of sections at one place only the last has characters.
    begins = np.concatenate(([0], np.cumsum([len(text) for text in texts]))).astype(np.int64)
    after = char_of[data == 10] + 1
    own = np.searchsorted(begins, after - 1, "right") - 1
    starts, text = np.concatenate((begins[:-1], after)), np.concatenate((np.arange(len(texts)), own))
    order = np.lexsort((starts, text))
    starts, text = starts[order], text[order]
    owner, crossing = attribute(char_of[until - lengths], char_of[until - 1] + 1, starts, total)
    ends = np.where(np.append(text[1:], -1) == text, np.append(starts[1:], total), begins[text + 1])
    first = np.searchsorted(text, np.arange(len(texts)))
    count = len(starts)
    columns = [
        np.arange(count) - first[text],
        starts - begins[text],
        ends - begins[text],
        np.bincount(owner, minlength=count),
        np.bincount(owner[crossing], minlength=count),
    ]
    arrays = [ids.cast(pa.int64()).take(pa.array(text)), *(pa.array(x.astype(np.int64)) for x in columns)]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing"])
