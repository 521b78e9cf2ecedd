"""Every operator and stage on awkward rows and on an empty table."""

import corpus_brute as brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex

import corpus_pipeline
from tripforge.llm import bpe, counting, exact, mixing, neardup, paragraphs, quality, secrets, sharding, substrings


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture
def operators(vocabulary, work):
    return {
        "near": lambda d: neardup.near_duplicates(d, work),
        "quality": lambda d: quality.quality(quality.measured(d)),
        "sharding": sharding.sharded,
        "paragraphs": lambda d: paragraphs.removal_counts(d, work),
        "exact": lambda d: exact.exact_groups(exact.by_age(d), work),
        "bpe": lambda d: bpe.encoded(d, vocabulary),
        "secrets": secrets.secret_spans,
        "substrings": lambda d: substrings.removed_substrings(d, work),
    }


NAMES = ["near", "quality", "sharding", "paragraphs", "exact", "bpe", "secrets", "substrings"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_row(operators, awkward, name):
    rows = operators[name](awkward).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in awkward.collect())


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(operators, nothing, name):
    assert operators[name](nothing).collect() == []


def test_near_copies_and_missing_ids(awkward, work):
    rows = {r.doc_id: r for r in neardup.near_duplicates(awkward, work).collect() if r.doc_id}
    assert [rows[i].component_id for i in (1, 2, 3)] == [1, 1, 1]
    assert rows[4].kept and rows[5].kept and rows[7].kept and rows[4].n_shingles == 0
    assert rows[6].n_shingles == 1


def test_exact_groups_keep_the_largest_id(awkward, work):
    rows = {r.doc_id: r for r in exact.exact_groups(exact.by_age(awkward), work).collect() if r.doc_id}
    assert (rows[1].keep_id, rows[1].group_size, rows[1].kept) == (2, 3, False)
    assert (rows[4].keep_id, rows[5].kept) == (5, True)
    assert rows[8].group_size == 2 and rows[8].kept


def test_sections_add_up(awkward, vocabulary):
    whole = {(r.doc_id, r.n_tokens) for r in bpe.encoded(awkward, vocabulary).where("doc_id is not null").collect()}
    parts = counting.section_tokens(awkward.distinct(), vocabulary).where("doc_id is not null").groupBy("doc_id").sum("n_tokens")
    assert {(r[0], r[1]) for r in parts.collect()} == whole


def test_sections_of_awkward_texts(spark, nothing, vocabulary):
    """Texts end to end: empty ones, ones that end in line breaks, runs of breaks in one token."""
    texts = ["", "\n", "a\n", None, "", "x\n\n\n\n\ny", "\n\n", "é\né\n\n ü" * 3, "", "last\n\n\n", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {}
    for r in counting.section_tokens(docs, vocabulary).collect():
        got.setdefault(r.doc_id, []).append((r.start_char, r.end_char, r.n_tokens, r.n_crossing))
    split = regex.compile(vocabulary.pattern)
    for key, text in enumerate(texts):
        pieces = [vocabulary.tokens[x] for x in bpe.encode([text or ""], vocabulary, split)[0]]
        assert got[key] == brute.sections(text or "", pieces)
    assert counting.section_tokens(nothing, vocabulary).collect() == []


def test_sections_count_packed_ids(vocabulary, monkeypatch):
    """No list of ids is made per text."""
    monkeypatch.setattr(counting, "encode", None, raising=False)
    split, texts = regex.compile(vocabulary.pattern), ["a wordy line\nb", "", "é\n"]
    sizes = np.array([len(x) for x in vocabulary.tokens])
    rows = counting._sections(pa.array([1, 2, 3]), texts, vocabulary, split, sizes).to_pylist()
    counts = {i: sum(r["n_tokens"] for r in rows if r["doc_id"] == i) for i in (1, 2, 3)}
    assert list(counts.values()) == [len(ids) for ids in bpe.encode(texts, vocabulary, split)] and counts[2] == 0


def test_long_chunks_are_not_remembered(vocabulary):
    split = regex.compile(vocabulary.pattern)
    texts = ["z" * 5_000, "short words", "z" * 5_000]
    assert bpe.encode(texts, vocabulary, split)[0] == bpe.encode(texts[2:], vocabulary, split)[0]
    assert all(len(chunk) <= bpe.LONGEST for chunk in vocabulary.chunks)


def test_pre_tokens_are_merged_once(vocabulary, monkeypatch):
    """Also in another chunk of a later slice, or after the chunks were forgotten; what is remembered is no list."""
    split, merged = regex.compile(vocabulary.pattern), []
    merge = bpe.Vocabulary.merge
    monkeypatch.setattr(bpe.Vocabulary, "merge", lambda self, pieces: merged.append(pieces) or merge(self, pieces))
    vocabulary.chunks.clear()
    alone = bpe.encode(["qzxjvw"], vocabulary, split)[0]
    assert bpe.encode(["qzxjvw,"], vocabulary, split)[0][: len(alone)] == alone
    vocabulary.chunks.clear()
    assert bpe.encode(["qzxjvw"], vocabulary, split)[0] == alone
    assert [piece for pieces in merged for piece in pieces] == [b"qzxjvw"]
    assert all(type(ids) is bytes for ids in vocabulary.chunks.values())


def test_merges_laid_out_together_or_apart(vocabulary, monkeypatch):
    """Pre-tokens of all lengths, whether their lists are laid out in one go or in many."""
    pieces = [("qzxjvw" * n)[: 5 * n + 1].encode() for n in (1, 40, 2, 9_000, 3, 1, 200)] + ["éüñ".encode() * 30]
    whole = list(vocabulary.merge(pieces))
    assert [b"".join(vocabulary.tokens[x] for x in ids) for ids in whole] == pieces
    monkeypatch.setattr(bpe, "MERGED_TOGETHER", 64)
    assert list(vocabulary.merge(pieces)) == whole == [next(vocabulary.merge([piece])) for piece in pieces]
    assert list(vocabulary.merge([])) == []


def test_mixing_covers_null_sources_and_repeated_rows(awkward, nothing, spark):
    copies = mixing.mixed_copies(awkward, epochs=3.0).collect()
    per_row = {}
    for r in copies:
        per_row[r.doc_id] = per_row.get(r.doc_id, 0) + 1
    assert per_row[8] % 2 == 0
    assert any(r.source is None for r in copies)
    assert mixing.mixed_copies(nothing).collect() == []


@pytest.mark.parametrize("number", range(5))
def test_stages(spark, awkward, nothing, number):
    name, stage = corpus_pipeline.STAGES[number]
    docs = awkward.withColumnRenamed("band", "kept")
    rows = stage(spark, docs, "")
    if number < 4:
        assert rows.columns == docs.columns
    assert rows.count() > 0 or number == 0
    assert stage(spark, nothing.withColumnRenamed("band", "kept"), "").count() == 0


def test_rows_without_an_id_take_part_in_near_dedup(spark):
    """Near copies go whether or not they have an id; of a group the row with the smallest id stays."""
    words = [f"w{i}" for i in range(60)]
    other = [f"v{i}" for i in range(60)]
    rows = [
        (1, " ".join(words)), (None, " ".join(words + ["more"])), (None, " ".join(words[1:])), (None, " ".join(other)),
        (None, " ".join(other + ["x"])), (None, "alone " * 9), (None, None), (2, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert (1, rows[0][1]) in left and rows[1] not in left and rows[2] not in left
    assert len([x for x in left if x in rows[3:5]]) == 1
    assert rows[5] in left and rows[6] in left and rows[7] in left
