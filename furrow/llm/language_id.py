"""Language identification, words first.

A word that was seen in training scores its log frequency in each language. An unseen word falls back to its longest
character n-grams of which any was seen, then to shorter ones. A text's words are summed.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.llm.sampling import sample_per_class
from furrow.llm.tables import documents, released, slices, values
from furrow.schemas import require_columns
from furrow.workspace import materialize

UNDETERMINED = "und"
LONGEST_GRAM = 4
LETTERS = regex.compile(r"\p{L}+")
COUNTS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("key", pa.string()), ("n", pa.int64())])
COUNTS_SCHEMA = "lang string, size int, key string, n long"
PREDICTION = ["doc_id", "lang_pred", "score", "familiar", "runs"]
FAMILIAR = 3  # times a word occurs in training before it counts as familiar
HELD_KEYS = 200_000  # distinct words a training task holds before it hands out its counts
TEXT_AT_ONCE = 2_000_000  # bytes whose words it counts at once
HELD_WORDS = 150_000  # words a scoring task remembers
MARKS = b"!\"'()*,-.:;?[]"  # that often stand around words
EVIDENCE = 25.0  # words' worth of evidence at most in a score


class Keys(Mapping):
    """Rows of a matrix by distinct string, in a few arrays: some 30 bytes a key where a dict of strings has 150.

    Keys are found by their hashes, which are sorted, and compared in full. The first row is ``first``, and the rows
    follow the order of the hashes.
    """

    def __init__(self, keys: list[str], first: int = 0):
        coded = sorted((xxhash.xxh3_64_intdigest(k := key.encode("utf-8", "surrogatepass")), k) for key in keys)
        self.first = first
        self.hashes = np.array([h for h, _ in coded], np.uint64)
        self.ends = np.cumsum([0, *(len(k) for _, k in coded)], dtype=np.int64)
        self.text = b"".join(k for _, k in coded)

    def _key(self, at: int) -> bytes:
        return self.text[self.ends[at] : self.ends[at + 1]]

    def get(self, key: str, default: int | None = None) -> int | None:
        coded = key.encode("utf-8", "surrogatepass")
        wanted = xxhash.xxh3_64_intdigest(coded)
        hashes = self.hashes.data  # a view, which bisect reads faster than the array
        at = bisect_left(hashes, wanted)
        while at < len(hashes) and hashes[at] == wanted:
            if self._key(at) == coded:
                return self.first + at
            at += 1
        return default

    def rows(self, keys: list[bytes]) -> np.ndarray:
        """Row of every key in UTF-8, -1 for those not held."""
        if not len(self) or not keys:
            return np.full(len(keys), -1)
        wanted = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self) - 1)
        rows = np.where(self.hashes[at] == wanted, at + self.first, -1)
        text, ends = self.text, zip(self.ends[at].tolist(), self.ends[at + 1].tolist())
        same = np.fromiter((text[a:b] == key for key, (a, b) in zip(keys, ends)), bool, len(keys))
        for i in np.flatnonzero((rows >= 0) & ~same).tolist():  # another key of this hash
            rows[i] = self.get(keys[i].decode("utf-8", "surrogatepass"), -1)
        return rows

    def __getitem__(self, key: str) -> int:
        row = self.get(key)
        if row is None:
            raise KeyError(key)
        return row

    def __contains__(self, key: object) -> bool:
        return isinstance(key, str) and self.get(key) is not None

    def __iter__(self) -> Iterator[str]:
        return (self._key(at).decode("utf-8", "surrogatepass") for at in range(len(self)))

    def __len__(self) -> int:
        return len(self.hashes)


@dataclass
class LanguageModel:
    """Log frequencies: ``tables[0]`` of words, ``tables[n]`` of n-grams; a row of ``matrix`` has a value per language.

    ``familiar`` tells which words occur at least ``FAMILIAR`` times in what was learned from.
    """

    languages: list[str]
    tables: list[Keys]
    matrix: np.ndarray
    familiar: np.ndarray

    def word(self, word: str) -> np.ndarray:
        """Score of one lower-case word in every language."""
        row = self.tables[0].get(word)
        if row is not None:
            return self.matrix[row]
        for size in range(min(LONGEST_GRAM, len(word) + 2), 0, -1):
            rows = [r for g in grams(word, size) if (r := self.tables[size].get(g)) is not None]
            if rows:
                return self.matrix[rows].mean(0)
        return np.zeros(len(self.languages), np.float32)

    def words(self, words: list[bytes]) -> np.ndarray:
        """:meth:`word` of many words in UTF-8, and whether each is familiar."""
        rows = self.tables[0].rows(words)
        out = np.empty((len(words), len(self.languages) + 1), np.float32)
        out[:, :-1] = self.matrix[rows]
        out[:, -1] = (rows >= 0) & self.familiar[rows] if len(self.familiar) else 0
        for i in np.flatnonzero(rows < 0).tolist():
            out[i, :-1] = self.word(words[i].decode("utf-8", "replace"))
        return out


def grams(word: str, size: int) -> list[str]:
    """Character n-grams of a word between boundary marks; single characters without the marks."""
    marked = word if size == 1 else f"^{word}$"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters."""
    return LETTERS.findall(text.lower())


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int | None = 5_000,
    words_per_language: int | None = 50_000,
    grams_per_language: int | None = 20_000,
) -> LanguageModel:
    """Learn from rows with a language.

    The fit uses about ``docs_per_language`` rows of each language, chosen by a hash of the id, or all with ``None``; the model holds
    the most frequent words and n-grams of each size up to the given numbers per language, or all with ``None``; so the
    model's size depends on the numbers given and on that of languages only. Texts without letters and rows without id, text or language teach nothing.
    """
    require_columns(docs, [id_col, text_col, lang_col])
    rows = documents(docs, id_col, text_col, lang=docs[lang_col].cast("string"))
    rows = rows.where("doc_id is not null and text is not null and lang is not null")
    if docs_per_language is not None:
        rows = sample_per_class(rows, "lang", "doc_id", docs_per_language)
    counts = rows.select("lang", "text").mapInArrow(_count, COUNTS_SCHEMA)
    counts = materialize(counts.groupBy("lang", "size", "key").agg(F.sum("n").alias("n")), "language-counts")
    place = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "key"))
    words = counts.where("size = 0").withColumn("place", place)
    parts = counts.where("size > 0").withColumn("place", place)
    if words_per_language is not None:
        words = words.where(F.col("place") <= words_per_language)
    if grams_per_language is not None:
        parts = parts.where(F.col("place") <= grams_per_language)
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()
    kept = words.unionByName(parts).select("lang", "size", "key", "n").toArrow()
    return _model(kept, [tuple(r) for r in totals])


@released
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each language, cut and counted between blanks by Arrow: Python sees each that a portion has once."""
    held: dict[str, Counter] = {}
    for batch in batches:
        named = batch.column(0).dictionary_encode()
        for at, lang in enumerate(named.dictionary.to_pylist()):
            texts, own = batch.column(1).filter(pc.equal(named.indices, at)), held.setdefault(lang, Counter())
            for part in slices(texts.view(pa.string()), TEXT_AT_ONCE):
                counted = pc.ascii_split_whitespace(part).flatten().view(pa.binary()).value_counts()
                for word, n in zip(counted.field(0).to_pylist(), counted.field(1).to_pylist()):
                    own[word] += n
                if sum(map(len, held.values())) > HELD_KEYS:
                    yield from _counted(held)
                    held = {lang: (own := Counter())}
    yield from _counted(held)


def _counted(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, raw in held.items():
        words: Counter = Counter()
        for part, n in raw.items():
            for word in words_of(part.decode("utf-8", "replace")):
                words[word] += n
        for size in range(LONGEST_GRAM + 1):
            if size:
                counted = Counter()
                for word, n in words.items():
                    for gram in grams(word, size):
                        counted[gram] += n
            else:
                counted = words
            columns = [[lang] * len(counted), [size] * len(counted), list(counted), list(counted.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COUNTS)], schema=COUNTS)


def _model(kept: pa.Table, sums: list[tuple]) -> LanguageModel:
    languages = sorted({lang for lang, _, _ in sums})
    totals = np.zeros((LONGEST_GRAM + 1, len(languages)))
    for lang, size, n in sums:
        totals[size, languages.index(lang)] = n
    first, tables, parts = 0, [], []
    for size in range(LONGEST_GRAM + 1):
        own = kept.filter(pc.equal(kept["size"], size))
        coded = own["key"].combine_chunks().dictionary_encode()
        keys = coded.dictionary.to_pylist()
        table = Keys(keys, first)
        rows = np.fromiter(map(table.__getitem__, keys), np.int64, len(keys)) - first
        counts = np.zeros((len(table), len(languages)))
        column = pc.index_in(own["lang"], pa.array(languages, pa.string())).to_numpy()
        counts[rows[coded.indices.to_numpy()], column] = own["n"].to_numpy()
        # Half a count for what a language was not seen to use.
        parts.append(np.log((counts + 0.5) / (totals[size] + 0.5 * len(table) + 1)).astype(np.float32))
        tables.append(table)
        first += len(table)
        if size == 0:
            familiar = counts.sum(1) >= FAMILIAR
    return LanguageModel(languages, tables, np.concatenate(parts), familiar)


class _Scores(dict):
    """Row of a matrix per word between blanks, as its bytes stand in a text: scores, familiar letter runs, letter runs."""

    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model = model
        self.limit = max(1_000, min(HELD_WORDS, 20_000_000 // max(1, len(model.languages))))
        self.rows = np.zeros((self.limit, len(model.languages) + 2), np.float32)

    def learn(self, fresh: list[bytes]) -> None:
        words, owners = [], []
        for i, raw in enumerate(fresh):
            bare = raw.strip(MARKS)
            if bare.isalpha():  # ASCII only
                words.append(bare.lower())
                owners.append(i)
            else:
                found = words_of(raw.decode("utf-8", "replace"))
                words.extend(w.encode("utf-8") for w in found)
                owners.extend([i] * len(found))
        first, sums = len(self), np.zeros((len(fresh), self.rows.shape[1]))
        np.add.at(sums[:, :-1], owners, self.model.words(words))
        sums[:, -1] = np.bincount(np.array(owners, np.int64), minlength=len(fresh))
        self.rows[first : first + len(fresh)] = sums
        self.update(zip(fresh, range(first, first + len(fresh))))

    def of(self, words: list[bytes]) -> np.ndarray:
        """A row for each of some distinct words."""
        out = np.empty((len(words), self.rows.shape[1]), np.float32)
        for at in range(0, len(words), self.limit // 2):
            part = words[at : at + self.limit // 2]
            if len(self) + len(part) > self.limit:
                self.clear()
            if fresh := [word for word in part if word not in self]:
                self.learn(fresh)
            out[at : at + len(part)] = self.rows[np.fromiter(map(self.__getitem__, part), np.int64, len(part))]
        return out

    def totals(self, texts: pa.Array) -> np.ndarray:
        """Sums over the words of each text; the last values are the numbers of familiar and of all letter runs.

        Words are cut and numbered by Arrow, so that Python sees each distinct word of the texts once.
        """
        if not self.model.languages:
            return np.zeros((len(texts), self.rows.shape[1]))
        split = pc.ascii_split_whitespace(texts)
        numbered = split.flatten().dictionary_encode()
        own = self.of(numbered.dictionary.view(pa.binary()).to_pylist())
        which = numbered.indices.to_numpy()
        ends = split.offsets.to_numpy() - split.offsets[0].as_py()
        if len(texts) == 1:  # however long it is
            return np.bincount(which, minlength=len(own)).astype(float)[None] @ own
        out = np.zeros((len(texts), own.shape[1]))
        some = np.flatnonzero(np.diff(ends))
        if len(some):
            out[some] = np.add.reduceat(own[which], ends[some], axis=0, dtype=float)
        return out


def _judged(totals: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the best language of each text (``languages`` if it has none), its share, and that of familiar runs."""
    sums, n = totals[:, :-2], totals[:, -1]
    familiar = totals[:, -2] / np.maximum(n, 1)
    if not languages:
        return np.zeros(len(totals), np.int64), np.zeros(len(totals)), familiar
    best = sums.argmax(1)
    scale = np.minimum(n, EVIDENCE) / np.maximum(n, 1)
    apart = scale[:, None] * (sums - sums[np.arange(len(sums)), best][:, None])
    share = 1 / np.exp(apart).sum(1)
    return np.where(n > 0, best, languages), np.where(n > 0, share, 0.0), familiar


def predict(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep: Column | None = None
) -> DataFrame:
    """``(doc_id, lang_pred, score, familiar, runs)`` of every row; with a column ``keep`` also it, as ``row``, and ``text``.

    ``und`` with score 0 if the text is null or has no letter, or nothing was learned. The score is the share of the
    language among all, from at most ``EVIDENCE`` words' worth of the mean score; ties go to the language that sorts
    first. ``runs`` counts the runs of letters, and ``familiar`` is the share of them that are words of which training
    had ``FAMILIAR`` or more. Repeated rows score alike; an empty table gives an empty result; other columns take no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a size bounded by the parameters of fit
    whole = keep is not None

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, languages = _Scores(shared.value), np.array([*shared.value.languages, UNDETERMINED], object)
        octets = max(100_000, 10_000_000 // max(5, len(languages)))
        for batch in batches:
            texts = batch.column(1).view(pa.string()).fill_null("")
            done = 0
            for part in slices(texts, octets):
                totals = scores.totals(part)
                found, share, familiar = _judged(totals, len(languages) - 1)
                columns = [pa.array(languages[found], pa.string()), pa.array(share), pa.array(familiar)]
                columns.append(pa.array(totals[:, -1].astype(np.int64)))
                rest = batch.slice(done, len(part))
                more = batch.schema.names[1:] if whole else []
                done += len(part)
                yield pa.RecordBatch.from_arrays(
                    [rest.column(0), *columns, *(rest.column(c) for c in more)], [*PREDICTION, *more]
                )

    texts = documents(docs, id_col, text_col, **({} if keep is None else {"row": keep}))
    schema = T._parse_datatype_string("doc_id long, lang_pred string, score double, familiar double, runs long")
    return texts.mapInArrow(run, T.StructType([*schema.fields, *(texts.schema.fields[1:] if whole else [])]))


def usual_familiarity(scored: DataFrame, known: Column) -> dict[str, float]:
    """Median ``familiar`` by predicted language, of the rows of :func:`predict` that are ``known``."""
    usual = scored.where(known).groupBy("lang_pred").agg(F.percentile_approx("familiar", 0.5).alias("familiar"))
    return dict(usual.collect())  # a row per language
