"""The manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest

from tripforge.llm import merkle
from tripforge.llm.queries import QUERIES
from tripforge.session import Workspace

NAMES = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [str(row[c]) if row[c] is not None else None for c in NAMES[:4]] + [text]
    return digest(*["-" if f is None else f"{len(f.encode())}:{f}" for f in fields])


def climb(level):
    """Root, and per leaf the (left, right) siblings of each run from the leaf up."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for p, i in zip(paths, at, strict=True):
            start = i - i % 8
            p.append(("".join(level[start:i]), "".join(level[i + 1 : start + 8])))
        level = [digest(*level[i : i + 8]) for i in range(0, len(level), 8)]
        at = [i // 8 for i in at]
    return level[0], paths


def expected(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append((r["doc_id"], leaf(r, r["text"]), r))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: climb([h for _, h, _ in sorted(langs[k], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for k in order}
    root, above = climb([trees[k][0] for k in order])
    out = []
    for place, k in enumerate(order):
        for (key, own, r), path in zip(sorted(langs[k], key=lambda x: (x[0] is not None, x[0] or 0, x[1])), trees[k][1], strict=True):
            steps, text = path + above[place], r["text"]
            if key is not None and zlib.crc32(str(key).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for a, b in steps:
                node = digest(a, node, b)
            proof = digest(*[a + b for a, b in steps])
            out.append((key, own, trees[k][0], root, proof, node, node == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_matches_a_plain_tree(spark, small_tables):
    docs = spark.read.parquet(f"{small_tables}/documents.parquet").collect()
    got = rows_of(QUERIES["op12_merkle_manifest"](spark, small_tables))
    assert got == expected(docs)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("size", [1, 2, 8, 9, 64, 65, 73, 520])
def test_tree_shapes(spark, work, size):
    rows = [(i, f"s{i % 3}", "en" if i else "de", i, f"Text {i}") for i in range(size)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert rows_of(merkle.manifest(docs, work)) == expected(docs.collect())


def test_many_languages(spark, work):
    rows = [(i, "s", None if i % 90 == 0 else f"{'é' * (i % 7)}{i % 90}", i, "AbC") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert rows_of(merkle.manifest(docs, work)) == expected(docs.collect())


def test_awkward_rows(spark, awkward, nothing):
    assert rows_of(merkle.manifest(awkward, Workspace(spark, "test"))) == expected(awkward.collect())
    assert merkle.manifest(nothing, Workspace(spark, "test")).collect() == []
