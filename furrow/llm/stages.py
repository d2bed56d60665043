"""Operators as steps on a table of documents: each returns the rows that stay, with the columns of its input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm import exact_dedup, language_id, ngram_join, packing, substring_dedup
from furrow.workspace import checkpoint

ABOVE_CHANCE = 1e-3
# A text that has fewer familiar words than this share of its letter runs, and than this part of what is usual in its
# language, is in none. Of fewer runs than ``FEW_RUNS`` too little is known to tell.
LEAST_FAMILIAR, PART_OF_USUAL, FEW_RUNS = 0.2, 0.25, 8


def keep_languages(docs: DataFrame) -> DataFrame:
    """Rows whose text has a language.

    Those without letters go, those that fit all languages alike, and those of eight letter runs or more of which
    hardly any is a word that the training rows use repeatedly, against what is usual for texts of the predicted
    language. The languages are learned from all rows that name one, and what is usual is the median of them all. With
    none to learn from, letters are all that is asked for.
    """
    model = language_id.fit(docs, docs_per_language=None)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # Written once, for the median and the decision both read it; Spark can remove it when nothing refers to it, so that
    # a copy of all texts need not outlast the stage.
    scored = checkpoint(language_id.predict(docs, model, keep=_rest(docs)))
    named = F.col("doc_id").isNotNull() & F.col("row")["lang"].isNotNull()
    usual = language_id.usual_familiarity(scored, named)
    good = F.col("lang_pred") != language_id.UNDETERMINED
    if len(model.languages) > 1:
        good &= F.col("score") * len(model.languages) > 1 + ABOVE_CHANCE
    least = F.lit(0.0)
    for language, share in usual.items():
        least = F.when(F.col("lang_pred") == language, min(LEAST_FAMILIAR, PART_OF_USUAL * share)).otherwise(least)
    good &= (F.col("runs") < FEW_RUNS) | (F.col("familiar") >= least)
    return scored.where(good).select(*_columns(docs, F.col("text").cast("string")).values())


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """Of rows with equal normalised text, the one with the smallest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(docs: DataFrame, rule: ngram_join.Rule = ngram_join.Rule(words=5, percent=80)) -> DataFrame:
    """Of every component of linked documents, the one with the smallest id. Rows without an id stay."""
    found = ngram_join.similar_documents(docs, rule)
    dropped = found.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("_dropped"))
    return docs.join(dropped, docs["doc_id"].cast("long") == dropped["_dropped"], "left_anti")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """Texts without the passages that occur earlier; a text that loses nothing stays as it is, blanks included.

    What is left of a changed text has one space between words, and ``n_chars``, if there, is its length. A document
    that loses all its words goes.
    """
    found = substring_dedup.remove_repeats(docs, keep=_rest(docs)).where("n_words = 0 or n_removed < n_words")
    columns = _columns(docs, F.col("text").cast("string"))
    if "n_chars" in columns:
        length = F.length(F.col("text").cast("string")).cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("n_removed") > 0, length).otherwise(columns["n_chars"]).alias("n_chars")
    return found.select(*columns.values())


def _rest(docs: DataFrame) -> Column:
    """All columns but the text, as one."""
    return F.struct(*[docs[c] for c in docs.columns if c != "text"])


def _columns(docs: DataFrame, text: Column) -> dict[str, Column]:
    """The columns of ``docs`` out of a result with ``row``, as :func:`_rest` makes it, and ``text``."""
    return {c: (text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns}


def pack(docs: DataFrame) -> DataFrame:
    """Sequences of at most 2048 tokens: the pieces of :func:`furrow.llm.packing.pack_documents`."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
