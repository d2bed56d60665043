from __future__ import annotations

import os
import random

import numpy as np
import pytest

import corpus_pipeline
from furrow.llm import language_id, stages
from tests.llm import plain
from tools.compare import compare, oracle_connection

DATA = "/root/testdata/sf0.001"


def near_copies_dropped(rows):
    found = plain.near_components(rows, 5, 80)
    return [(i, t) for i, t in rows if found[i][1] == i]


def repeats_cut(rows):
    out = []
    for i, (n, kept) in plain.without_repeats(rows).items():
        text = dict(rows)[i]
        if kept or not n:
            out.append((i, text if len(kept) == n else " ".join(kept)))
    return out


def plain_stages(rows):
    """The rows after each stage but the last; the language stage keeps texts with letters."""
    yield (rows := [(i, t) for i, t in rows if plain.has_letter(t)])
    keep = plain.copies(rows)
    yield (rows := [(i, t) for i, t in rows if keep[i] == i])
    yield (rows := near_copies_dropped(rows))
    yield repeats_cut(rows)


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def run_stages(spark, table, path):
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns = table.columns
        out = stage(spark, table, DATA)
        out.write.parquet(path(str(k)))
        table = spark.read.parquet(path(str(k)))
        assert k == len(corpus_pipeline.STAGES) - 1 or table.columns == columns
        yield table


def test_every_stage_against_plain_python(spark, path):
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    done = list(run_stages(spark, table, path))
    for got, want in zip(done, plain_stages(pairs(table))):
        assert pairs(got) == sorted(want)
    assert done[3].where("n_chars != length(text)").count() == 0
    packed = done[4].groupBy("doc_id").sum("length").count()
    assert packed == done[3].count()
    final = corpus_pipeline.run(spark, DATA)
    columns = ["doc_id", "start", "length", "ids", "doc_tokens"]
    assert final.count() == done[4].count() and final.groupBy("doc_id").sum("length").exceptAll(done[4].groupBy("doc_id").sum("length")).count() == 0
    assert set(columns) <= set(final.columns)


def test_planted_rows(docs, spark, path):
    random.seed(9)
    prose = lambda n: " ".join(random.choice(["thea", "nder", "stion", "hean", "ere", "ou"]) + str(random.randint(0, 99)) for _ in range(n))
    clean, passage = [prose(90) for _ in range(12)], prose(60)
    base = clean[0].split()
    near = " ".join([*base[:45], "other", *base[46:]])
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(20, clean[3].replace(" ", "\n ")), (21, near), (30, f"{prose(40)} {passage}"), (31, f"{passage} {prose(40)}")]
    rows += [(40, None), (41, ""), (42, "... 12"), (43, passage)]
    done = [{r["doc_id"]: r["text"] for r in t.collect()} for t in run_stages(spark, docs(rows), path) if "text" in t.columns]
    assert set(range(12)) <= set(done[3]) and all(done[3][i] == clean[i] for i in range(12))
    assert not {40, 41, 42} & set(done[0]) and 20 in done[0] and 20 not in done[1]
    assert 21 in done[1] and 21 not in done[2] and {30, 31, 43} <= set(done[2])
    assert done[3][30] == dict(rows)[30] and done[3][31] == " ".join(rows[15][1].split()[60:]) and 43 not in done[3]


@pytest.mark.parametrize("stage", [stages.keep_languages, stages.drop_exact_copies, stages.drop_near_copies, stages.cut_repeats])
def test_stages_keep_columns_and_take_empty_tables(docs, clashing, stage):
    text = "the thing is of and to a word in this place for all"
    table = clashing([(1, text), (2, text + " again"), (3, text), (4, "x y")])
    out = stage(table)
    assert out.columns == table.columns
    assert {1, 4} <= {r["doc_id"] for r in out.collect()}
    assert all(r["row"] == "x" and r["lang"] == "en" for r in out.collect())
    assert stage(docs([])).count() == 0


def test_rows_without_id_or_text(docs):
    rows = [(None, "the word"), (1, None), (2, "")]
    assert pairs(stages.drop_near_copies(docs(rows[:1]))) == [(None, "the word")]
    assert sorted(map(str, pairs(stages.cut_repeats(docs(rows[1:]))))) == ["(1, None)", "(2, '')"]


def noise(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))


def test_the_language_stage_rejects_letter_noise_and_keeps_short_texts(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rng, rows = random.Random(3), []
    for k, r in enumerate(table.collect()):
        words = (r["text"] or "").split()
        rows.append((20_000_000 + k, " ".join(words[:2]), r["lang"], "s", 9))
        if len(words) > 12:
            rows.append((10_000_000 + k, " ".join(words[3 : 3 + rng.randint(5, 9)]), r["lang"], "s", 9))
    bad = [(30_000_000 + k, noise(rng, rng.randint(8, 60)), rng.choice(["en", "de", None]), "s", 9) for k in range(60)]
    more = spark.createDataFrame(rows + bad, table.schema)
    kept = {r["doc_id"] for r in stages.keep_languages(table.union(more)).collect()}
    assert {r["doc_id"] for r in table.collect() if plain.has_letter(r["text"])} <= kept
    short = [i for i, *_ in rows if 10_000_000 <= i < 20_000_000]
    assert len(short) > 100 and sum(i in kept for i in short) >= 0.99 * len(short)
    assert sum(i in kept for i, *_ in bad) <= 3


def test_the_evidence_of_the_language_stage(docs):
    """By hand: a text of eight runs or more goes if too few of them are words that training has three times."""
    rows = [(i, "one two three four five six seven eight", "en") for i in range(8)]
    rows += [(20, "one bb cc dd ee ff gg bc", "en"), (21, "bb cc dd ee ff gg bc", "en"), (23, "mm nn oo pp qq rr ss tt", "en")]
    rows += [(22, "hh ii jj kk ll ab one one", "en")]
    kept = {r["doc_id"] for r in stages.keep_languages(docs(rows)).collect()}
    # Familiar: 1 of 8 (least: 0.2), too short to tell, none, 2 of 8.
    assert kept == {*range(8), 21, 22}


SQL = ["op1_substring_dedup", "op3_warc", "op5_ngram_join", "op8_exact_dedup", "op10_topk", "op11_spelling", "op13_periodic_runs"]


@pytest.mark.parametrize("name", SQL)
def test_queries_match_their_sql(spark, name):
    good, note = compare(spark, oracle_connection(DATA), name, DATA)
    assert good, note


def test_the_language_stage_learns_from_all_rows(docs, monkeypatch):
    """More rows of a language than the sample of a bounded fit has: every word is counted, and no sample is drawn."""
    rows = [(i, f"the word number w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}", "en") for i in range(6_000)]
    seen, keep = [], language_id.predict
    monkeypatch.setattr(language_id, "predict", lambda docs, model, *a, **k: seen.append(model) or keep(docs, model, *a, **k))
    monkeypatch.setattr(language_id, "sample_per_class", lambda *a: pytest.fail("a sample"))
    assert stages.keep_languages(docs(rows)).count() == 6_000
    (model,) = seen
    want = np.log((6_000 + 0.5) / (4 * 6_000 + 0.5 * 103 + 1))
    assert len(model.tables[0]) == 103 and np.allclose(model.word("the"), want)


def test_stages_leave_no_table_that_their_result_does_not_read(docs, spark, path, monkeypatch):
    """Copies of texts, shingles and tiles go when a stage has used them; what a result reads stays."""
    rows = [(i, f"the small house by the river has {i // 3} old doors and green windows", "en") for i in range(60)]
    docs([*rows, (3, "another text of the same id"), (70, ""), (71, None), (None, "no id")]).write.parquet(path("docs"))
    monkeypatch.setattr("furrow.workspace.workspace_root", lambda _: path("workspace"))
    for stage in (stages.keep_languages, stages.drop_exact_copies, stages.drop_near_copies):
        result = stage(spark.read.parquet(path("docs")))
        assert result.count() > 0 and result.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    left = {name.rsplit("-", 1)[0] for name in os.listdir(path("workspace").removeprefix("file://"))}
    assert not left & {
        "languages", "copy-contents", "digest-collisions", "shingle-sets", "shingle-candidates", "shingle-arrays", "shingle-roots",
        "tiles", "tile-roots", "prefix-keys", "prefix-tiles", "bounded-pairs", "links", "roots", "repeated-ids", "joined-roots",
    }
    assert {"copies", "shingle-members", "set-components", "components-of-repeated-ids"} <= left
