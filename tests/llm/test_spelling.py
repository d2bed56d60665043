from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from furrow.llm import queries, spelling
from tests.llm import plain

DATA = "/root/testdata/sf0.001"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n, ratio=5):
    out, form = {}, {}
    for a in n:
        near = [b for b in n if one_edit(a, b)]
        best = min(near, key=lambda b: (-n[b], b), default=None)
        form[a] = best if best is not None and n[best] >= ratio * n[a] else None
        out[a] = len(near)
    for a in n:
        root = a
        while form[root]:
            root = form[root]
        out[a] = (form[a], root, n[a], out[a], n[form[a]] if form[a] else None)
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "word string, n long")


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def some_counts(rng, letters, size, longest):
    words = {"".join(rng.choices(letters, k=rng.randint(1, longest))) for _ in range(size)}
    return {w: rng.choice([1, 2, 5, 9, 30, 150, 800]) for w in sorted(words)}


@pytest.mark.parametrize("letters, size, longest", [("ab", 120, 8), ("abcé", 250, 6), ("eainàéÿstr😀", 300, 5)])
def test_like_comparing_all_words(spark, monkeypatch, letters, size, longest):
    monkeypatch.setattr(spelling, "WORDS_TO_A_BLOCK", 7)  # branches are split, and named by many levels
    monkeypatch.setattr(spelling, "QUESTIONS_TO_A_BLOCK", 30)
    n = some_counts(random.Random(size), letters, size, longest)
    assert found(spelling.variants(table(spark, list(n.items())))) == plain_variants(n)


def test_long_words_and_words_of_the_same_letters(spark):
    rng = random.Random(1)
    long = ["x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 150, "ab" * 40, "ab" * 40 + "c", "b" + "ab" * 39, "a" * 70_000, "a" * 69_999]
    same = {"".join(rng.sample("abcdefgh", 8)) for _ in range(400)}
    swapped = {w[:3] + "z" + w[4:] for w in list(same)[:40]}
    n = {w: rng.choice([1, 6, 40]) for w in sorted([*long, *same, *swapped])}
    assert found(spelling.variants(table(spark, list(n.items())))) == plain_variants(n)


def test_chains_ties_and_odd_rows(spark):
    rows = [("aaaaaa", 1), ("aaaaab", 5), ("aaaabb", 25), ("aaabbb", 125), ("aabbbb", 625), ("abbbbb", 3125), ("zz", 4), ("zz", 5)]
    rows += [("yyx", 90), ("yyw", 90), ("yy", 2), (None, 5), ("", 7), ("q", None)]
    n = {"zz": 9, **{w: k for w, k in rows if w and w != "zz" and k}}
    got = found(spelling.variants(table(spark, rows).selectExpr("*", "'x' AS form", "'y' AS branch", "1 AS root")))
    assert got == plain_variants(n) and got["aaaaaa"][1] == "abbbbb" and got["yy"][0] == "yyw"
    assert spelling.variants(table(spark, [])).count() == 0
    assert found(spelling.variants(table(spark, [("one", 1)]))) == {"one": (None, "one", 1, 0, None)}
    with pytest.raises(ValueError):
        spelling.variants(table(spark, []), ratio=1)


def contract_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(plain.UPPER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}


def test_op11(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = found(queries.op11_spelling(spark, DATA))
    assert got == plain_variants(contract_counts(docs)) and any(r[0] for r in got.values())


def test_op11_without_texts(spark, docs, path):
    rows = [(i, "ÀBCDEF abcdeé ABCDEÉ abcdeÉ") for i in range(1, 9)] + [(9, None), (10, ""), (11, "123")]
    docs(rows).write.parquet(path("t") + "/documents.parquet")
    assert found(queries.op11_spelling(spark, path("t"))) == plain_variants(contract_counts(rows))
    docs([]).write.parquet(path("e") + "/documents.parquet")
    assert queries.op11_spelling(spark, path("e")).count() == 0
