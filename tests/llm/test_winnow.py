"""Decontamination against all windows compared one by one."""

import hashlib
import random
import re

import numpy as np
import pytest

from tripforge.llm import winnow
from tripforge.llm.flat import U64, mixed
from tripforge.llm.queries import QUERIES
from tripforge.session import Workspace

DOCS, ITEMS = "doc_id long, text string, item string, n_words long", "item_id long, text string, row long, found string"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def expected(docs, items):
    windows = {}
    for key, text in items:
        own = words(text)
        for i in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(tuple(own[i : i + 10]), set()).add("" if key is None else str(key))
    sizes = {len(w) for w in windows}
    out = []
    for key, text in docs:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                named = windows.get(tuple(own[i : i + size]))
                if named:
                    hit |= set(range(i, i + size))
                    found |= named
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(own), len(hit), len(found), ids, bool(hit)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_matches_all_windows(spark, small_tables):
    docs = spark.read.parquet(f"{small_tables}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{small_tables}/benchmark.parquet").select("item_id", "text").collect()
    got = rows_of(QUERIES["op13_decontamination"](spark, small_tables))
    assert got == expected(docs, items)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_passages_of_every_length(spark, work, monkeypatch, broadcast):
    monkeypatch.setattr(winnow, "MAX_BROADCAST", broadcast)
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)] + ["Éa", "x9", "Z"]
    texts = [" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(4, 40))) for _ in range(30)]
    items = [(i % 25, t, 1, "x") for i, t in enumerate(texts)] + [(90 + n, " ".join(["solo"] * n), 1, "x") for n in range(5)]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(4):
            own = words(draw.choice(texts))
            start = draw.randrange(len(own))
            parts += own[start : start + draw.randrange(1, 16)] + [draw.choice(vocabulary)] * draw.randrange(3) + ["solo"] * draw.randrange(4)
        docs.append((i, ",- ".join(parts).upper(), "x", 3))
    got = winnow.decontaminated(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), work)
    assert rows_of(got) == expected([d[:2] for d in docs], [i[:2] for i in items])


def test_awkward_rows(spark, awkward, nothing):
    items = [(1, None, 1, "x"), (2, "", 1, "x"), (None, "one two three four five six seven eight nine ten eleven", 1, None),
             (3, "LINE", None, "x"), (3, "word " * 40, 1, "x"), (4, "é" * 400 + " line", 1, "x"), (10, "line", 1, "x"), (10, "line", 1, "x")]
    benchmark = spark.createDataFrame(items, ITEMS)
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    assert rows_of(winnow.decontaminated(awkward, benchmark, Workspace(spark, "test"))) == expected(docs, [i[:2] for i in items])
    empty = benchmark.where("item_id = 99")
    assert rows_of(winnow.decontaminated(awkward, empty, Workspace(spark, "test"))) == expected(docs, [])
    assert winnow.decontaminated(nothing, benchmark, Workspace(spark, "test")).collect() == []


def test_screen_holds_every_fingerprint(spark):
    prints = mixed(np.arange(5_000, dtype=U64))
    made = winnow.screen(spark.createDataFrame([(int(x),) for x in prints[:2_000].view(np.int64)], "print long"))
    assert made.holds(prints[:2_000]).all() and made.holds(prints[2_000:]).mean() < 0.01


def test_equal_windows_keep_equal_fingerprints():
    draw = np.random.default_rng(2)
    shared = mixed(draw.integers(0, 99, 10).astype(U64))
    for _ in range(50):
        left, right = draw.integers(0, 20, 2)
        hashes = np.concatenate((mixed(draw.integers(0, 99, left).astype(U64)), shared, mixed(draw.integers(0, 99, right).astype(U64))))
        starts, prints = winnow.fingerprints(hashes, np.zeros(len(hashes), np.int64), 10)
        alone = winnow.fingerprints(shared, np.zeros(10, np.int64), 10)[1]
        assert prints[starts == left][0] == alone[0]
