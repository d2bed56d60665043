"""The registered queries of the text operators: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm import (
    byte_bpe,
    exact_dedup,
    language_id,
    license_scan,
    ngram_join,
    packing,
    periodic,
    piece_bpe,
    quality,
    spelling,
    substring_dedup,
    topk,
    warc,
)
from furrow.llm.sampling import remainder
from furrow.llm.tables import BLANKS
from furrow.workspace import new_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", _sha256("kept").alias("kept_sha256"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0))
    return quality.score(docs, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = new_path(spark, "archive")
    warc.write_pages(_table(spark, sf_dir, "pages"), archive)
    return warc.resolve_revisits(warc.read_archive(spark, archive)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(_table(spark, sf_dir, "documents"), path, specials=True).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"), ngram_join.Rule(words=4, percent=85))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    tokens = F.length("ids") - F.length(F.replace(F.col("ids"), F.lit(" "), F.lit(""))) + 1
    return coded.select(
        "doc_id",
        F.when(F.col("ids") == "", 0).otherwise(tokens).cast("long").alias("n_tokens"),
        _sha256("ids").alias("ids_sha256"),
        _sha256("decoded").alias("decoded_sha256"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(remainder("doc_id", 4) != 2))
    held_out = (remainder("doc_id", 4) == 2).alias("held_out")
    return language_id.predict(docs, model).select("doc_id", held_out, "lang_pred", "score")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = exact_dedup.tag_copies(_table(spark, sf_dir, "documents"))
    return tags.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spelled(docs: DataFrame) -> DataFrame:
    """``(word, n)``: runs of Latin letters, some of them with a letter lost, by their number in all texts."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z\u00C0-\u00FF]+"), F.lit(0))).alias("run"))
    # Texts of ASCII alone may be put in lower case as they are, which is faster than letter by letter.
    ascii_only = F.octet_length("run") == F.length("run")
    lower = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER))
    runs = runs.select("doc_id", lower.alias("run"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    runs = runs.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    lost = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % 199 == 0, lost).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= 6).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.where("n >= 5")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_spelled(_table(spark, sf_dir, "documents")), ratio=5)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = piece_bpe.round_trip(_table(spark, sf_dir, "documents"), path, end=2)
    tokens = F.length("ids") - F.length(F.replace(F.col("ids"), F.lit(" "), F.lit(""))) + 1
    return coded.select(
        "doc_id",
        tokens.cast("long").alias("n_tokens"),
        _sha256("ids").alias("ids_sha256"),
        _sha256("decoded").alias("decoded_sha256"),
    )


def _made_periodic(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, by their id, repeat some of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", BLANKS), lambda word: word != "")

    def repeated(own: Column) -> Column:
        n, g = F.size(own).cast("long"), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int")
        return F.when(n > 0, F.array_join(F.transform(own, lambda _, i: F.get(own, place(i))), " "))

    # The words are bound once, as the one element of an array, rather than cut out anew for each of them.
    periodic = F.transform(F.array(words), repeated)[0]
    text = F.when((h % 10 == 0) & F.col("text").isNotNull(), periodic).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(_made_periodic(_table(spark, sf_dir, "documents")))

    def better(best: Column, run: Column) -> Column:  # runs come by start, then period
        longer = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | longer, run).otherwise(best)

    none = F.lit(None).cast(found.schema["runs"].dataType.elementType)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.col("best")
    return found.withColumn("best", F.reduce("runs", none, better)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[name].alias(name) for name in ("start", "length", "period")],
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n")))).cast("binary"), 256).alias("runs_sha256"),
        _sha256("collapsed").alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality": op2_quality,
    "op3_warc": op3_warc,
    "op4_packing": op4_packing,
    "op5_ngram_join": op5_ngram_join,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_language_id": op7_language_id,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_topk": op10_topk,
    "op11_spelling": op11_spelling,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_periodic_runs": op13_periodic_runs,
}
