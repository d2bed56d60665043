from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from furrow.llm import periodic, queries
from tests.llm import plain

DATA = "/root/testdata/sf0.001"


def plain_runs(words, least_words=24, periods=3):
    """``(start, length, period)`` by comparing the words with themselves at every lag."""
    numbers = np.unique(words, return_inverse=True)[1] if len(words) else np.empty(0, int)
    seen, out = set(), []
    for q in range(1, len(words) // periods + 1):
        same = np.concatenate([[False], numbers[q:] == numbers[:-q], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(turns[::2].tolist(), turns[1::2].tolist()):
            n = j + q - i
            if n >= max(least_words, periods * q) and (i, n) not in seen:
                seen.add((i, n))
                out.append((i, n, q))
    return sorted(out)


def left(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(random):
    out = []
    for _ in range(random.randint(0, 6)):
        kinds = random.choice([1, 2, 3, 50])
        block = [f"w{random.randrange(kinds)}" for _ in range(random.choice([1, 2, 5, 15, 16, 17, 22, 23, 24, 30, 31, 45, 60]))]
        if random.random() < 0.8:
            out += block * random.choice([1, 2, 3, 4, 7]) + block[: random.randint(0, len(block))]
        else:
            out += [f"w{random.randrange(kinds)}" for _ in range(random.randint(0, 90))]
    return out


def test_like_every_lag():
    rng = random.Random(13)
    for _ in range(150):
        docs = [some_words(rng) for _ in range(rng.randint(1, 5))]
        number = {w: i for i, w in enumerate(sorted({w for d in docs for w in d}))}
        ends = np.cumsum([0, *map(len, docs)])
        got = periodic.find_runs(np.array([number[w] for d in docs for w in d], np.int32), ends)
        assert got == [(i, *run) for i, d in enumerate(docs) for run in plain_runs(d)]


@pytest.mark.parametrize("period", [1, 7, 16, 17, 18, 29, 100, 333, 1000])
def test_the_least_run_of_each_period(period):
    n = max(24, 3 * period)
    line = np.arange(10_000, 10_000 + 2 * n)
    line[5 : 5 + n] = np.arange(n) % period
    assert periodic.find_runs(line, np.array([0, len(line)])) == [(0, 5, n, period)]
    line[5 + n - 1] = 9_999  # one word short
    assert periodic.find_runs(line, np.array([0, len(line)])) == []


def test_other_least_sizes():
    words = np.tile(np.arange(20), 4)
    ends = np.array([0, 80])
    assert periodic.find_runs(words, ends, periodic.Least(4, 5)) == []
    assert periodic.find_runs(np.array([1, 2] * 3), np.array([0, 6]), periodic.Least(4, 3)) == [(0, 0, 6, 2)]
    with pytest.raises(ValueError):
        periodic.Least(4, 2)


def test_long_texts_of_few_words():
    ends = np.array([0, 200_000])
    assert periodic.find_runs(np.zeros(200_000, np.int32), ends) == [(0, 0, 200_000, 1)]
    assert periodic.find_runs(np.arange(200_000) % 50_000, ends) == [(0, 0, 200_000, 50_000)]
    # A pattern that repeats at two lengths.
    inner = [*[0] * 30, 1] * 5
    assert periodic.find_runs(np.array(inner), np.array([0, len(inner)])) == [
        (0, s, n, q) for s, n, q in plain_runs([str(i) for i in inner])
    ]


def test_tables(spark, docs, clashing, monkeypatch):
    monkeypatch.setattr(periodic, "PORTION", 400)
    text = "lead  in\t" + "a b c d e\n" * 9 + "tail"
    rows = [(1, text), (2, None), (3, ""), (4, " \n\t "), (1, text), (None, text), (5, "é ü " * 12), (6, "one two")]
    got = sorted(map(str, periodic.collapse(clashing(rows)).collect()))
    assert got == sorted(map(str, periodic.collapse(docs(rows)).collect()))
    for r in periodic.collapse(docs(rows)).collect():
        words = plain.words(dict(rows)[r["doc_id"]])
        runs = plain_runs(words)
        assert (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) == (len(words), runs, left(words, runs))
    assert sum(len(r["runs"]) for r in periodic.collapse(docs(rows)).collect()) == 4
    assert periodic.collapse(docs([])).count() == 0


def test_op13(spark):
    """The query over the whole table, against plain Python."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, DATA).collect()}
    assert set(got) == set(texts)
    found = 0
    for doc_id, text in texts.items():
        words, h = plain.words(text), zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        runs = plain_runs(words)
        r = got[doc_id]
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert (r["n_runs"], r["runs_sha256"]) == (len(runs), hashlib.sha256(lines.encode()).hexdigest())
        assert r["collapsed_sha256"] == plain.sha256(left(words, runs))
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (best[1] * 1000 // best[2] if runs else None)
        found += len(runs)
    assert found


def test_op13_without_ids_and_texts(spark, docs, path):
    docs([(None, "a " * 40), (8, None), (9, ""), (10, "x")]).write.parquet(path("t") + "/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, path("t")).collect()}
    assert got[None]["n_runs"] == 1 and got[8]["n_runs"] == got[9]["n_runs"] == 0
    assert got[8]["collapsed_sha256"] == got[9]["runs_sha256"] == plain.sha256("")
