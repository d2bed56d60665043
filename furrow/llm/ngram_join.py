"""Similarity join of documents by the Jaccard measure of their word shingles, and its connected components.

1. Documents with the same set of shingles become one set.
2. A fingerprint of every shingle goes to a bucket that counts it. A set can only be linked if enough of its shingles
   occur in other sets as well; the few that pass have their sorted shingles stored.
3. Tiles of sets with the same smallest shingles link most copies to one another at little cost.
4. Sets that could still be linked across components share a shingle of their prefixes: they meet in tiles of one
   shingle, and one band of sizes if there are many. Bit counts of hashed signatures bound their overlap from above; what passes is
   decided by intersecting the sorted arrays.

Steps 2 and 4 lose no link: a link needs the share of common shingles that step 2 asks for, and two sets that
overlap as much as a link needs have a shingle in common among the first ``n - needed(n) + 1`` of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.components import connected
from furrow.llm.tables import (
    WordHashes,
    buckets_for,
    documents,
    mixed,
    released,
    total_words,
    values,
    window_hashes,
    word_hashes,
)
from furrow.workspace import discarded, materialize, new_path, written

BASE = 0x9E3779B97F4A7C15
BLOCK = 1_000_000  # shingles whose fingerprints a task sends at once
BLOCK_SETS = 60_000
BUCKET = 2_000_000  # fingerprints per bucket
TILE = 2_000  # sets that a task compares at once
BATCH = 20_000  # rows of tiles that a task takes at once
SIGNATURE_BITS = 2_048
QUICK_KEYS = 3

MEMBERS = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary()), *[(f"k{i}", pa.int64()) for i in range(QUICK_KEYS)]]
)
MEMBERS_SCHEMA = "doc_id long, n long, set_key binary, " + ", ".join(f"k{i} long" for i in range(QUICK_KEYS))
ARRAYS = pa.schema([("v", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary())])
ARRAYS_SCHEMA = "v long, n long, shingles binary"
COUNT, MANIFEST = 0, 1
REQUEST = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int8()), ("owners", pa.binary()), ("data", pa.binary())]
)
REQUEST_SCHEMA = "bucket int, block long, kind byte, owners binary, data binary"


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; a link needs ``100 * intersection >= percent * union``."""

    words: int = 5
    percent: int = 80

    def least_overlap(self, a: np.ndarray | int, b: np.ndarray | int):
        """Smallest overlap with which sets of sizes ``a`` and ``b`` are linked."""
        return -(-(a + b) * self.percent // (100 + self.percent))

    def least_share(self, n: np.ndarray | int):
        """Smallest overlap of a set of size ``n`` with any set it is linked with."""
        return -(-n * self.percent // 100)


def shingles(text: bytes | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text, A-Z in lower case; of a shorter text, one of the whole."""
    own = hashes.of((text or b"").lower().split())
    if not len(own):
        return np.empty(0, np.uint64)
    width = min(words, len(own))
    return np.unique(mixed(window_hashes(own, width, BASE) + np.uint64(width)))


def similar_documents(
    docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs``.

    ``component_id`` is the smallest id reachable by links, the row's own included. A text without words, or null, has
    no shingles and no link. Rows with equal ids are one node; a row without an id is linked with nothing and has no
    component. An empty table gives an empty result; other columns take no part.
    """
    texts = documents(docs, id_col, text_col)
    members = materialize(texts.mapInArrow(lambda b: _members(b, rule), MEMBERS_SCHEMA), "shingle-members")
    spark = docs.sparkSession
    kept = new_path(spark, "set-components"), new_path(spark, "components-of-repeated-ids")
    with discarded(spark):  # what the result does not read
        of_set, of_id = _components(texts, members, rule)
        of_set, of_id = written(of_set, kept[0]), None if of_id is None else written(of_id, kept[1])
    alone = F.col("doc_id")
    if of_id is not None:  # a row without words whose id has others
        members, alone = members.join(of_id, "doc_id", "left"), F.coalesce("of_id", "doc_id")
    component = F.when(F.col("n") == 0, alone).otherwise(F.coalesce("component", "v"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return members.join(of_set, "set_key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def _components(texts: DataFrame, members: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame | None]:
    """``(set_key, v, component)`` of every set; if ids have several rows, ``(doc_id, of_id)`` of these, else none."""
    quick = [f"k{i}" for i in range(QUICK_KEYS)]
    sets = members.where("n > 0 and doc_id is not null").groupBy("set_key")
    sets = materialize(sets.agg(F.min("doc_id").alias("v"), *[F.first(k).alias(k) for k in quick]), "shingle-sets")

    known = texts.where("doc_id is not null")
    buckets = buckets_for(total_words(texts), BUCKET)
    requests = known.mapInArrow(lambda b: _requests(b, rule, buckets), REQUEST_SCHEMA)
    answers = requests.groupBy("bucket").applyInArrow(_answers, REQUEST_SCHEMA)
    possible = answers.groupBy("block").applyInArrow(lambda t: _possible(t, rule), "set_key binary").distinct()
    candidates = materialize(sets.join(possible, "set_key"), "shingle-candidates")
    wanted = candidates.select(F.col("v").alias("doc_id"), "set_key", *quick)
    arrays = known.join(wanted, "doc_id").mapInArrow(lambda b: _arrays(b, rule), ARRAYS_SCHEMA)
    arrays = materialize(arrays, "shingle-arrays")

    roots = candidates.select("v", F.col("v").alias("root"), *quick)
    for key in quick:
        merged = _link_tiles(arrays, roots.where("v = root").select("v", F.col(key).alias("key")), rule)
        roots = materialize(
            roots.join(merged, "root", "left").withColumn("root", F.coalesce("new_root", "root")).drop("new_root"),
            "shingle-roots",
        )
    roots = roots.select("v", "root")
    links = _links_between(arrays, roots, rule)
    # An id with several rows is one node, so it links the components of all its sets.
    repeated = members.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    repeated = materialize(repeated.where("rows > 1").select("doc_id"), "repeated-ids")
    some = not repeated.isEmpty()
    if some:
        own = members.where("n > 0").join(repeated, "doc_id").select("doc_id", "set_key").distinct()
        own = own.join(sets.select("set_key", "v"), "set_key").join(roots.distinct(), "v", "left")
        own = materialize(own.select("doc_id", "v", F.coalesce("root", "v").alias("root")), "sets-of-repeated-ids")
        links = links.unionByName(own.select(F.col("doc_id").alias("a"), F.col("root").alias("b")))
        roots = roots.unionByName(own.select("v", "root")).distinct()
    joined = connected(links).select(F.col("node").alias("root"), F.col("root").alias("new_root"))
    if some:
        joined = materialize(joined, "joined-roots")
        of_id = own.join(joined, "root", "left").groupBy("doc_id")
        of_id = of_id.agg(F.min(F.coalesce("new_root", "root")).alias("of_id"))
    roots = roots.join(joined, "root", "left").select("v", F.coalesce("new_root", "root").alias("component"))
    if some:
        roots = roots.distinct()  # a node whose sets had different roots

    return sets.select("set_key", "v").join(roots, "v", "left"), of_id if some else None


@released
def _members(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    hashes = word_hashes()
    for batch in batches:
        columns: list[list] = [[] for _ in MEMBERS]
        for name, text in zip(*map(values, batch.columns)):
            own = shingles(text, rule.words, hashes)
            keys = own[:QUICK_KEYS].view(np.int64).tolist()
            row = [name, len(own), xxhash.xxh3_128_digest(own.tobytes()), *keys, *[None] * (QUICK_KEYS - len(keys))]
            for column, value in zip(columns, row):
                column.append(value)
        yield _rows(columns, MEMBERS)


def _rows(columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


@released
def _requests(batches: Iterator[pa.RecordBatch], rule: Rule, buckets: int) -> Iterator[pa.RecordBatch]:
    hashes, number = word_hashes(), TaskContext.get().partitionId() << 32
    sets: dict[bytes, np.ndarray] = {}
    held = 0
    for batch in batches:
        for text in values(batch.column(1)):
            own = shingles(text, rule.words, hashes)
            if len(own):
                held += len(own)
                sets[xxhash.xxh3_128_digest(own.tobytes())] = own
            if held >= BLOCK or len(sets) >= BLOCK_SETS:
                yield _request(sets, number, buckets)
                sets, held, number = {}, 0, number + 1
    if sets:
        yield _request(sets, number, buckets)


def _request(sets: dict[bytes, np.ndarray], block: int, buckets: int) -> pa.RecordBatch:
    """Fingerprints of the sets of one block by bucket, and the block's list of sets."""
    sizes = np.array([len(s) for s in sets.values()], np.uint32)
    value = mixed(np.concatenate(list(sets.values())))
    owner = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    place = ((value >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(place, kind="stable")
    place, owner, value = place[order], owner[order], value[order].astype(np.uint32)
    cuts = np.append(0, np.flatnonzero(place[1:] != place[:-1]) + 1)
    owners = [o.tobytes() for o in np.split(owner, cuts[1:])] + [sizes.tobytes()]
    data = [v.tobytes() for v in np.split(value, cuts[1:])] + [b"".join(sets)]
    n = len(cuts)
    return _rows([[*place[cuts].tolist(), block % buckets], [block] * (n + 1), [COUNT] * n + [MANIFEST], owners, data], REQUEST)


def _answers(table: pa.Table) -> pa.Table:
    """For each block, the owners of the bucket's fingerprints that occur more than once; lists of sets pass through."""
    manifest = np.array(table.column("kind").to_numpy()) == MANIFEST
    passed, counted = table.filter(pa.array(manifest)), table.filter(pa.array(~manifest))
    if not counted.num_rows:
        return passed
    parts = [np.frombuffer(d, np.uint32) for d in values(counted.column("data"))]
    value = np.concatenate(parts)
    order = np.argsort(value)
    value = value[order]
    same = value[1:] == value[:-1]
    again = np.zeros(len(value), bool)
    again[order[np.append(same, False) | np.append(False, same)]] = True
    ends = np.cumsum([len(p) for p in parts])[:-1]
    owners = [
        np.frombuffer(o, np.uint16)[m].tobytes() for o, m in zip(values(counted.column("owners")), np.split(again, ends))
    ]
    n = len(owners)
    answer = [[0] * n, counted.column("block").to_pylist(), [COUNT] * n, owners, [None] * n]
    return pa.concat_tables([passed.cast(REQUEST), pa.Table.from_batches([_rows(answer, REQUEST)])])


def _possible(table: pa.Table, rule: Rule) -> pa.Table:
    """The sets of one block of which enough shingles occur elsewhere."""
    keys, sizes, owners = b"", np.empty(0, np.uint32), []
    for kind, own, data in zip(*(values(table.column(c)) for c in ("kind", "owners", "data"))):
        if kind == MANIFEST:
            keys, sizes = data, np.frombuffer(own, np.uint32)
        else:
            owners.append(np.frombuffer(own, np.uint16))
    found = np.bincount(np.concatenate(owners), minlength=len(sizes)) if owners else np.zeros(len(sizes), int)
    enough = np.flatnonzero(found >= rule.least_share(sizes.astype(np.int64)))
    return pa.table({"set_key": pa.array([keys[16 * i : 16 * i + 16] for i in enough], pa.binary())})


@released
def _arrays(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """The sorted shingles of the rows whose set is wanted."""
    hashes = word_hashes()
    for batch in batches:
        columns: list[list] = [[], [], []]
        for name, text, set_key in zip(*map(values, batch.columns[:3])):
            own = shingles(text, rule.words, hashes)
            if xxhash.xxh3_128_digest(own.tobytes()) == set_key:
                for column, value in zip(columns, (name, len(own), own.tobytes())):
                    column.append(value)
        yield _rows(columns, ARRAYS)


def _link_tiles(arrays: DataFrame, keyed: DataFrame, rule: Rule) -> DataFrame:
    """``(root, new_root)`` of nodes ``keyed (v, key)`` that are linked inside a tile of equal keys.

    A key with more than ``TILE`` nodes is dealt over several tiles.
    """
    keyed = keyed.where("key is not null")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    tile = F.pmod(F.xxhash64("v"), F.ceil(F.col("size") / TILE))
    tiles = materialize(keyed.join(sizes, "key").select("v", "key", tile.alias("tile")), "tiles")
    linked = arrays.join(tiles, "v").groupBy("key", "tile").applyInArrow(lambda t: _tile(t, rule), "root long, new_root long")
    return materialize(linked, "tile-roots")


def signature(own: np.ndarray) -> np.ndarray:
    """Bits that the shingles of a set are hashed to, as 64-bit words."""
    bits = np.zeros(SIGNATURE_BITS, bool)
    bits[(own % np.uint64(SIGNATURE_BITS)).astype(np.int64)] = True
    return np.packbits(bits).view(np.uint64)


def overlap_bound(sizes_a, bits_a: np.ndarray, sizes_b, bits_b: np.ndarray) -> np.ndarray:
    """No pair of sets overlaps by more: every bit that one lacks stands for a shingle it lacks."""
    only_a = np.bitwise_count(bits_a & ~bits_b).sum(-1, dtype=np.int64)
    only_b = np.bitwise_count(bits_b & ~bits_a).sum(-1, dtype=np.int64)
    return np.minimum(sizes_a - only_a, sizes_b - only_b)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _tile(table: pa.Table, rule: Rule) -> pa.Table:
    """Components inside one tile, found by walking from set to set that is not reached yet."""
    node = table.column("v").to_numpy()
    own = [np.frombuffer(s, np.uint64) for s in values(table.column("shingles"))]
    sizes, bits = np.array([len(s) for s in own]), np.stack([signature(s) for s in own])
    waiting = np.argsort(node, kind="stable")
    found = []
    while len(waiting):
        root, reached, waiting = node[waiting[0]], [waiting[0]], waiting[1:]
        while reached and len(waiting):
            x = reached.pop()
            need = rule.least_overlap(sizes[x], sizes[waiting])
            near = overlap_bound(sizes[x], bits[x], sizes[waiting], bits[waiting]) >= need
            near[near] = [overlap(own[x], own[y]) >= k for y, k in zip(waiting[near], need[near])]
            reached.extend(waiting[near])
            found.extend((node[y], root) for y in waiting[near] if node[y] != root)
            waiting = waiting[~near]
    nodes, roots = zip(*found) if found else ((), ())
    return pa.table({"root": pa.array(nodes, pa.int64()), "new_root": pa.array(roots, pa.int64())})


def _prefixes(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = []
        for n, own in zip(*map(values, batch.columns[1:])):
            keys.append(np.frombuffer(own, np.int64)[: n - int(rule.least_share(n)) + 1].tolist())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(keys, pa.list_(pa.int64()))], ["v", "n", "keys"])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [signature(np.frombuffer(own, np.uint64)).tobytes() for own in values(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["v", "bits"])


def _links_between(arrays: DataFrame, roots: DataFrame, rule: Rule) -> DataFrame:
    """Links ``(a, b)`` between the roots of different components: every pair that could be one is decided.

    Sets meet with their signatures in tiles of one shared key; a tile gives the pairs that the bound lets pass, and
    only those have their arrays intersected.
    """
    prefixes = arrays.mapInArrow(lambda b: _prefixes(b, rule), "v long, n long, keys array<long>")
    keyed = materialize(
        prefixes.join(roots, "v").select(F.explode("keys").alias("key"), "v", "n", "root"), "prefix-keys"
    )
    mixed_keys = keyed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"))
    tiled = _dealt(keyed.join(mixed_keys.where("low != high").select("key", "size"), "key"), rule)
    signed = arrays.mapInArrow(_signatures, "v long, bits binary")
    schema = "a long, b long, root_a long, root_b long"
    # Most tiles are small, so a task takes a batch of them at a time.
    batches = max(1, -(-tiled.count() // BATCH))
    batch = F.pmod(F.xxhash64("key", "tile", "low", "high"), F.lit(batches)).alias("batch")
    met = tiled.select(batch, "*").join(signed, "v").groupBy("batch")
    pairs = materialize(met.applyInArrow(lambda t: _bounded(t, rule), schema).distinct(), "bounded-pairs")
    for side in ("a", "b"):
        own = arrays.select(F.col("v").alias(side), F.col("shingles").alias(f"shingles_{side}"))
        pairs = pairs.join(own, side)
    pairs = pairs.select("root_a", "root_b", "shingles_a", "shingles_b")
    return pairs.mapInArrow(lambda b: _exact(b, rule), "a long, b long").distinct()


def _dealt(keyed: DataFrame, rule: Rule) -> DataFrame:
    """Rows ``(key, size, v, n, root)`` dealt to the tiles in which they are compared.

    A key of up to ``TILE`` sets is one tile. A larger one has a tile per band of sizes, where the sets of the band meet
    one another and those of the band below (``below``), for linked sets are at most one band apart. A tile that is still
    larger is compared in blocks: a set goes to every pair of blocks with its own.
    """
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / rule.percent)))

    def place(tile, below):
        return F.struct(tile.cast("long").alias("tile"), F.lit(below).alias("below"))

    banded = F.array(place(band, False), place(band + 1, True))
    places = F.when(F.col("size") > TILE, banded).otherwise(F.array(place(F.lit(-1), False)))
    rows = keyed.select("key", "v", "n", "root", F.inline(places))
    blocks = rows.groupBy("key", "tile").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("blocks"))
    rows = rows.join(blocks, ["key", "tile"]).withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    pair = (F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    return materialize(rows.select("key", "tile", *pair, "block", "below", "v", "n", "root"), "prefix-tiles")


def _bounded(table: pa.Table, rule: Rule) -> pa.Table:
    """Pairs of sets that meet in a tile, of different roots and blocks, and may overlap enough."""
    names = ("key", "tile", "low", "high", "n", "v", "root", "block", "below")
    columns = [table.column(c).to_numpy() for c in names]
    bits = np.frombuffer(b"".join(values(table.column("bits"))), np.uint64).reshape(table.num_rows, -1)
    order = np.lexsort(columns[5::-1])  # by tile, then size
    key, tile, low, high, n, v, root, block, below = (c[order] for c in columns)
    bits = bits[order]
    new = (key[1:] != key[:-1]) | (tile[1:] != tile[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    stops = np.append(np.flatnonzero(new) + 1, len(v))
    stop_of = np.repeat(stops, np.diff(np.append(0, stops)))
    found: list[tuple[int, int]] = []
    # A set is compared with the larger ones of its tile that are within the rule's reach.
    for i, stop in enumerate(stop_of.tolist()):
        rest = slice(i + 1, stop)
        fit = (root[rest] != root[i]) & (n[rest] * rule.percent <= n[i] * 100) & ~(below[rest] & below[i])
        if low[i] != high[i]:
            fit &= block[rest] != block[i]
        at = i + 1 + np.flatnonzero(fit)
        if len(at):
            near = overlap_bound(n[i], bits[i], n[at], bits[at]) >= rule.least_overlap(n[i], n[at])
            found.extend((i, j) for j in at[near].tolist())
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return pa.table({"a": v[a], "b": v[b], "root_a": root[a], "root_b": root[b]})


def _exact(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for own in zip(*map(values, batch.columns[2:])):
            a, b = (np.frombuffer(s, np.uint64) for s in own)
            linked.append(overlap(a, b) >= rule.least_overlap(len(a), len(b)))
        roots = batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))
        yield pa.RecordBatch.from_arrays(roots.columns, ["a", "b"])
