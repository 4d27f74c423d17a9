"""Phrase collocations by SON partitioning.

Every document belongs to one of SHARDS shards.  A phrase that occurs at least
``support`` times has, in some shard, at least its proportional part of that:
if it had fewer than t = (support - 1) // SHARDS + 1 in each, it would have at
most SHARDS * (t - 1) < support in all.  Each shard is mined completely for
phrases with t occurrences (words and pairs first, then the phrases of three
words both of whose pairs are frequent), the locally frequent ones of all
shards are united, and all candidates are counted exactly over all texts.

Shards are not tasks.  A shard is mined by many tasks, each of which counts
its own texts, _RUN bytes at a time, before anything is shuffled, so no word or
phrase, however frequent, is more than one row per such run.  Most phrases of a
task occur once, so these rows are dealt out as they are: another table of
them in the task would take much memory and make few rows fewer.  Mining counts 64-bit hashes; a
collision can only add a candidate.  The candidates travel to the counting
pass as a Bloom filter of bounded size; what it lets through wrongly is
counted like the rest and falls below the support.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhawk.llm.bloom import bloom_filter, inside, mix
from tallyhawk.llm.common import cut, stored, table
from tallyhawk.llm.sentencepiece import runs as text_runs
from tallyhawk.llm.words import byte_kinds, split_words

#: Occurrences of a candidate, percent of its occurrences inside a longer one
#: that drop it, rows per language.
SUPPORT, INSIDE, TOP = 10, 50, 2000
SHARDS, PARTS = 3, 8
#: Bytes of text counted at a time by a task.
_RUN = 1 << 20
_KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _C[0] + b * _C[1])


class Counted:
    """The words of some texts: each distinct (language, word) numbered."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        words = split_words(texts, _KINDS, lower=True)
        coded = langs.dictionary_encode()
        lang = np.repeat(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(words.firsts))
        size = max(1, len(words.distinct))
        keys, self.word = np.unique(lang * size + words.codes, return_inverse=True)
        self.lang_of, self.langs = keys // size, coded.dictionary
        self.names = words.distinct.cast(pa.string()).take(pa.array(keys % size))
        said = [np.fromiter((xxhash.xxh3_64_intdigest(b) for b in x.cast(pa.binary()).to_pylist()), np.uint64, len(x))
                for x in (words.distinct, self.langs)]
        self.hash = _pair(said[0][keys % size], said[1][self.lang_of]) if len(keys) else np.zeros(0, np.uint64)
        self.joined = words.pieces[1:] == words.pieces[:-1]  # words i and i+1 stand in one piece
        self.h = self.hash[self.word]
        self.pair_hash = _pair(self.h[:-1], self.h[1:])

    def pairs_in(self, pairs: np.ndarray) -> np.ndarray:
        """For each word whether it and the next one may be a pair of the filter."""
        ok = np.append(self.joined, False) if len(self.h) else self.joined
        at = np.flatnonzero(self.joined)
        ok[at] = inside(pairs, self.pair_hash[at])
        return ok

    def triples(self, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the three-word phrases both of whose pairs are ``ok``."""
        first = np.flatnonzero(ok[:-1] & ok[1:])
        return first, _pair(self.pair_hash[first], self.h[first + 2])


def _texts(batches):
    for batch in batches:
        yield from text_runs(batch, "text", _RUN, 1 << 20)


def _shard_counts(docs: DataFrame, shards: int, pairs: np.ndarray | None) -> DataFrame:
    """h, c (counts by shard), counted per task first: of words and pairs, or,
    given the filter of frequent pairs, of three-word phrases made of those."""
    shared = None if pairs is None else docs.sparkSession.sparkContext.broadcast(pairs)

    def run(batches):
        shard = TaskContext.get().partitionId() % shards
        for part in _texts(batches):
            x = Counted(part.column("text"), part.column("lang"))
            if shared is None:
                h, c = np.unique(x.pair_hash[x.joined], return_counts=True)
                h, c = np.concatenate([x.hash, h]), np.concatenate([np.bincount(x.word, minlength=len(x.hash)), c])
            else:
                h, c = np.unique(x.triples(x.pairs_in(shared.value))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(np.full(len(h), shard, np.int32)), pa.array(c.astype(np.int64))], ["h", "shard", "c"]
            )

    each = [F.sum(F.when(F.col("shard") == i, F.col("c")).otherwise(0)) for i in range(shards)]
    # one row per phrase with its count in every shard: one shuffle
    return docs.mapInArrow(run, "h bigint, shard int, c bigint").repartition("h").groupBy("h").agg(F.array(*each).alias("c"))


def local_threshold(support: int, shards: int) -> int:
    return (support - 1) // shards + 1


def frequent_hashes(docs: DataFrame, support: int, shards: int, pairs: np.ndarray | None = None) -> DataFrame:
    """h of the phrases that are frequent in some shard; those whose counts
    (collisions included) don't add up to the support are left out."""
    total = F.aggregate("c", F.lit(0).cast("long"), lambda t, x: t + x)
    return (
        _shard_counts(docs, shards, pairs)
        .where((F.array_max("c") >= local_threshold(support, shards)) & (total >= support))
        .select("h")
    )


def exact_counts(docs: DataFrame, short: np.ndarray, long: np.ndarray, support: int) -> DataFrame:
    """lang, k, phrase, f of the phrases of 1 to 3 words with f >= support,
    candidates being those in the filters of words and pairs and of three-word
    phrases; with k = 0 the number of all words of each language."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(short), context.broadcast(long)

    def run(batches):
        for part in _texts(batches):
            x = Counted(part.column("text"), part.column("lang"))
            lists = []
            of_words = np.bincount(x.word, minlength=len(x.hash)).astype(np.int64)
            totals = np.bincount(x.lang_of, of_words, minlength=len(x.langs)).astype(np.int64)
            lists.append((0, np.arange(len(x.langs)), pa.array([""] * len(x.langs), pa.string()), totals))
            use = np.flatnonzero(inside(shared[0].value, x.hash))
            lists.append((1, x.lang_of[use], x.names.take(pa.array(use)), of_words[use]))
            pair, size, space = x.pairs_in(shared[0].value), max(1, len(x.hash)), pa.scalar(" ", pa.string())
            first = np.flatnonzero(pair)
            keys, number, counts = np.unique(x.word[first] * size + x.word[first + 1], return_inverse=True, return_counts=True)
            a, b = keys // size, keys % size
            names = pc.binary_join_element_wise(x.names.take(pa.array(a)), x.names.take(pa.array(b)), space)
            lists.append((2, x.lang_of[a], names, counts))
            numbers = np.full(len(pair), -1, np.int64)
            numbers[first] = number
            first, h = x.triples(pair)
            first = first[inside(shared[1].value, h)]
            keys, counts = np.unique(numbers[first] * size + x.word[first + 2], return_counts=True)
            ab, c = keys // size, keys % size
            names = pc.binary_join_element_wise(names.take(pa.array(ab)), x.names.take(pa.array(c)), space)
            lists.append((3, x.lang_of[a[ab]], names, counts))
            for k, lang, names, counts in lists:
                yield pa.RecordBatch.from_arrays(
                    [x.langs.take(pa.array(lang)), pa.array(np.full(len(lang), k, np.int32)), names, pa.array(counts.astype(np.int64))],
                    ["lang", "k", "phrase", "f"],
                )

    counted = docs.mapInArrow(run, "lang string, k int, phrase string, f bigint")
    return counted.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= support) | (F.col("k") == 0))


def scored_phrases(counts: DataFrame, covered: int = INSIDE) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that no longer one covers."""
    f = counts.where("k > 0").select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    long = counts.where("k > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"), "k")
    at = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = long.select("lang", "phrase", "a", "k", "w", at).select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"),
    )
    both = cuts.join(f.select("lang", F.col("part").alias("left"), F.col("part_f").alias("l")), ["lang", "left"]).join(
        f.select("lang", F.col("part").alias("right"), F.col("part_f").alias("r")), ["lang", "right"]
    )
    value = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    best = (
        both.withColumn("score", value)
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("m"))
        .select("lang", "phrase", "m.a", "m.l", "m.r", "m.score")
    )
    triples = long.where("k = 3")
    parts = F.explode(F.array(*(F.array_join(F.slice("w", i, 2), " ") for i in (1, 2)))).alias("phrase")
    longer = triples.select("lang", "a", parts).groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    return best.join(longer, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (100 * F.col("longest") < covered * F.col("a"))
    ).drop("longest")


def collocations(df: DataFrame, support: int = SUPPORT, covered: int = INSIDE, top: int = TOP, shards: int = SHARDS,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` best phrases of two
    and three words of each language.

    A-Z is lower-cased; pieces end at ``. , ; : ! ?`` and at line ends, words
    at spaces and tabs.  Null and empty texts have no words; a null language
    is ``und``.  Repeated rows count as often as they stand there.  Ties in
    score go to the more frequent phrase, then to the smaller one by its UTF-8
    bytes.  Other columns are ignored; an empty table gives an empty result.
    """
    docs = df.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    short = bloom_filter(cut(frequent_hashes(docs, support, shards)))
    long = bloom_filter(cut(frequent_hashes(docs, support, shards, short)))
    counts = stored(exact_counts(docs, short, long, support))
    n = counts.where("k = 0").select("lang", F.col("f").alias("n"))

    def place(*of):
        return F.row_number().over(Window.partitionBy(*of).orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")

    # the best of each part of a language first, so that the last step sees PARTS * top rows at most
    best = scored_phrases(counts, covered).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = best.withColumn("rank", place("lang", "part")).where(F.col("rank") <= top)
    best = best.withColumn("rank", place("lang")).where(F.col("rank") <= top)
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
g AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
p AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM g, (VALUES (1), (2), (3)) t(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM p WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM p WHERE k > 1 AND f >= {SUPPORT}),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS first, array_to_string(ws[cut + 1:k], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
s AS (
  SELECT x.lang, x.phrase, x.a, x.cut, y.f AS l, z.f AS r,
         (1000000::HUGEINT * x.a * x.a // (y.f::HUGEINT * z.f))::BIGINT AS score
  FROM cuts x JOIN p y ON y.lang = x.lang AND y.phrase = x.first JOIN p z ON z.lang = x.lang AND z.phrase = x.rest),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, part, max(a) AS a
  FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part FROM c WHERE k = 3)
  GROUP BY lang, part),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, phrase) AS rank
  FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.part = b.phrase
  WHERE g.a IS NULL OR 100 * g.a < {INSIDE} * b.a)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN n ON n.lang = r.lang WHERE rank <= {TOP}
"""
