"""Exact stratified splits and folds without sorting the table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.schemas import LABEL, LABEL_DOMAIN

_HASH = "_hash"
_BUCKET = "_bucket"
BUCKET_DIGITS = 4
COPIES_PER_CHUNK = 1_000_000


def row_hash(df: DataFrame, seed: int) -> Column:
    """The order key of a row: md5 over the seed and the text of its columns.

    Separators inside values are escaped, so that only equal rows share a text.
    """

    def text(name: str, dtype: str) -> Column:
        nested = dtype.startswith(("array", "map", "struct"))
        value = F.to_json(name) if nested else F.col(name).cast("string")
        if nested or dtype == "string":
            value = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        return F.coalesce(value, F.lit("\\N"))

    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[text(*field) for field in df.dtypes]))


@dataclass(frozen=True)
class Cut:
    """Where a part ends: after ``take`` of the ``copies`` rows whose hash is ``at``."""

    at: str
    copies: int
    take: int


def _find_cuts(
    rows: DataFrame, label: str, labels: Sequence[int], cut_ranks: Callable[[Column], list[Column]]
) -> dict[int, list[Cut]]:
    """Hash at each wanted rank, per label, from two passes that rank nothing but the surroundings of the cuts.

    The first counts rows per label and leading hash digits (at most labels * 16^BUCKET_DIGITS groups) and finds the
    buckets that hold a cut. The second counts rows per hash in those buckets, about one row in 16^BUCKET_DIGITS.
    The driver gets one row per label and cut each time.
    """

    def at_rank(counts: DataFrame, keys: list[str], order: str, need: Column) -> DataFrame:
        upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(order))
        ranked = counts.withColumn("_upto", upto).withColumn("_need", need)
        before = F.col("_upto") - F.col("_n")
        hit = (F.col("_upto") >= F.col("_need")) & (before < F.col("_need"))
        return ranked.where(hit).withColumn("_need", F.col("_need") - before)

    one = F.count(F.lit(1)).alias("_n")
    sizes = rows.groupBy(label, _BUCKET).agg(one)
    total = F.sum("_n").over(Window.partitionBy(label))
    ranks = F.array(*[rank.cast("long") for rank in cut_ranks(F.col("_total"))])
    sizes = sizes.withColumn("_total", total).select("*", F.posexplode(ranks).alias("_cut", "_rank"))
    buckets = at_rank(sizes, [label, "_cut"], _BUCKET, F.col("_rank")).collect()

    def found(r) -> Column:
        return (F.col(label) == r[label]) & (F.col(_BUCKET) == r[_BUCKET])

    cuts: dict[int, list[Cut]] = {v: [] for v in labels}
    if not buckets:
        return cuts
    near = rows.where(reduce(or_, [found(r) for r in buckets])).groupBy(label, _BUCKET, _HASH).agg(one)
    wanted = F.array(
        *[
            F.struct(F.lit(r["_cut"]).alias("_cut"), F.lit(r["_need"]).alias("_rank"), found(r).alias("_here"))
            for r in buckets
        ]
    )
    near = near.select("*", F.inline(F.filter(wanted, lambda w: w["_here"])))
    for r in at_rank(near, [label, "_cut"], _HASH, F.col("_rank")).orderBy("_cut").collect():
        cuts[r[label]].append(Cut(r[_HASH], r["_n"], r["_need"]))
    return cuts


def _assign_parts(
    df: DataFrame,
    label: str,
    labels: Sequence[int],
    cut_ranks: Callable[[Column], list[Column]],
    seed: int,
    part: str,
) -> DataFrame:
    """Number the parts that ``cut_ranks`` (increasing ranks, given the row count) cut each label's rows into.

    Rows are ranked from 1 in row-hash order per label; a row is in part i when i of the cuts are below its rank.
    Once the hashes at the cuts are known, the part of a row is a comparison with a few constants, so the table is
    neither sorted nor shuffled. It is read three times: materialize a costly input first.

    Rows with the same hash are exact copies. When a cut falls between copies, they are counted and written out
    again in chunks, so that a huge group of copies is spread over tasks.
    """
    columns = df.columns
    rows = (
        df.where(F.col(label).isin(*labels))
        .withColumn(_HASH, row_hash(df, seed))
        .withColumn(_BUCKET, F.substring(_HASH, 1, BUCKET_DIGITS))
    )
    cuts = _find_cuts(rows, label, labels, cut_ranks)

    def cuts_passed(passed: Callable[[Cut], Column]) -> Column:
        """Number of cuts of the row's label that lie before it."""
        per_label = [
            F.when(F.col(label) == v, sum((passed(c).cast("int") for c in cuts[v]), F.lit(0))) for v in labels
        ]
        return F.coalesce(*per_label).alias(part)

    def hash_passed(c: Cut) -> Column:
        return F.col(_HASH) > c.at

    parting = {v: [c.at for c in cuts[v] if c.take < c.copies] for v in labels}
    if not any(parting.values()):
        return rows.select(*columns, cuts_passed(hash_passed))
    apart = reduce(or_, [(F.col(label) == v) & F.col(_HASH).isin(at) for v, at in parting.items() if at])
    chunk = F.lit(COPIES_PER_CHUNK).cast("long")
    last = F.col("_first") + chunk - 1
    copies = (
        rows.where(apart)
        .groupBy(*columns, _HASH)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_first", F.explode(F.sequence(F.lit(1).cast("long"), "_n", chunk)))
        .repartition(F.col(_HASH), F.col("_first"))
        .withColumn("_copy", F.explode(F.sequence("_first", F.least("_n", last))))
    )
    copy_part = cuts_passed(lambda c: hash_passed(c) | ((F.col(_HASH) == c.at) & (F.col("_copy") > c.take)))
    whole = rows.where(~apart).select(*columns, cuts_passed(hash_passed))
    return whole.unionByName(copies.select(*columns, copy_part))


def stratified_split(
    df: DataFrame,
    label: str = LABEL,
    labels: Sequence[int] = LABEL_DOMAIN,
    fraction: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add ``split``: the first ceil(fraction * n) rows of each label in row-hash order are ``valid``, others ``train``.

    Rows whose label is not in ``labels`` are left out.
    """
    if not 0 < fraction < 1:
        raise ValueError(f"fraction must lie between 0 and 1, not {fraction}")
    parts = _assign_parts(df, label, labels, lambda n: [F.ceil(F.lit(float(fraction)) * n)], seed, "_part")
    split = F.when(F.col("_part") == 0, "valid").otherwise("train")
    return parts.withColumn("split", split).drop("_part")


def stratified_folds(
    df: DataFrame, label: str = LABEL, labels: Sequence[int] = LABEL_DOMAIN, k: int = 5, seed: int = 42
) -> DataFrame:
    """Add an int ``fold`` from 0 to k-1; fold sizes within a label differ by at most one."""

    def cut_ranks(n):
        return [F.floor((n * i + (k - 1)) / k) for i in range(1, k)]

    return _assign_parts(df, label, labels, cut_ranks, seed, "fold")
