"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities for the pieces of a fixed public vocabulary
(and for single bytes, so that any word has a segmentation).  A word's
probability is the sum over all its segmentations, by the forward algorithm;
a text's is the product over its words.  Words are lower-cased, split at white
space and marked by a space in front.

Each batch is turned into its distinct words; the forward algorithm runs over
thousands of words and all languages at once, position by position.  Piece
probabilities are learned by expectation maximisation: expected piece counts
from forward and backward sums over a bounded sample of labelled texts, summed
by Spark; only (languages x vocabulary) numbers come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import crc_fold, cut, join_lookup, sample_labelled, table
from tallyhawk.llm.sentencepiece import MODEL, load_model, runs

#: Labelled texts a language is learned from (drawn by a hash of the id) and
#: rounds of learning.
SAMPLE, ROUNDS = 500, 2
_BASE, _C1, _C2, _BITS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), 17


@dataclass
class Pieces:
    """Vocabulary as two hash tables over polynomial hashes (row 0 of every
    probability table stands for 'no piece')."""

    n: int
    longest: int
    keys: list[np.ndarray]
    rows: list[np.ndarray]
    powers: np.ndarray
    start: np.ndarray  # probabilities to begin learning with


def piece_hash(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * int(_BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def load_pieces(path: str = MODEL) -> Pieces:
    ordered = sorted(load_model(path).ids.items(), key=lambda x: x[1])
    texts = [bytes([b]) for b in range(256)]
    known = set(texts)
    texts += [t for p, _ in ordered if (t := p.encode()) not in known]
    keys = [np.zeros(1 << _BITS, np.uint64) for _ in range(2)]
    rows = [np.zeros(1 << _BITS, np.int32) for _ in range(2)]
    for row, text in enumerate(texts, 1):
        h, r, k = np.uint64(piece_hash(text)), row, 0
        for _ in range(500):  # cuckoo: an entry pushed out goes to the other table
            with np.errstate(over="ignore"):
                slot = int((h * (_C1 if k == 0 else _C2)) >> np.uint64(64 - _BITS))
            h, keys[k][slot] = keys[k][slot], h
            r, rows[k][slot] = rows[k][slot], r
            if r == 0:
                break
            k = 1 - k
        assert r == 0, "hash tables too small for the vocabulary"
    longest = max(map(len, texts))
    powers = [1]
    for _ in range(longest):
        powers.append(powers[-1] * int(_BASE) & 0xFFFFFFFFFFFFFFFF)
    # merges come in order of frequency: a Zipf law; bytes are rare
    weight = np.array([0.0] + [1e-3 if len(t) == 1 else 1 / (r + 100) for r, t in enumerate(texts, 1)])
    return Pieces(len(texts) + 1, longest, keys, rows, np.array(powers, np.uint64), weight / weight.sum())


def _find(p: Pieces, h: np.ndarray) -> np.ndarray:
    """Row of the piece with each hash, 0 if there is none."""
    a = ((h * _C1) >> np.uint64(64 - _BITS)).astype(np.int64)
    found = np.where(p.keys[0][a] == h, p.rows[0][a], 0)
    miss = np.flatnonzero(found == 0)
    b = ((h[miss] * _C2) >> np.uint64(64 - _BITS)).astype(np.int64)
    found[miss] = np.where(p.keys[1][b] == h[miss], p.rows[1][b], 0)
    return found


def _packed(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the marked words."""
    marked = pc.binary_join_element_wise(pa.scalar(" "), words, "").cast(pa.large_string())
    offsets = np.frombuffer(marked.buffers()[1], np.int64, len(marked) + 1, marked.offset * 8)
    return np.frombuffer(marked.buffers()[2], np.uint8), offsets


def _matrix(data: np.ndarray, offsets: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix hashes (positions x words) and lengths of the words in order."""
    lens = (offsets[1:] - offsets[:-1])[order]
    most = int(lens[0])
    h = np.zeros((most + 1, len(order)), np.uint64)
    first = offsets[:-1][order]
    for k in range(most):
        n = int(np.searchsorted(-lens, -k, "left"))  # words longer than k
        h[k + 1, :n] = h[k, :n] * _BASE + data[first[:n] + k].astype(np.uint64) + np.uint64(1)
    return h, lens


def forward(p: Pieces, probs: np.ndarray, words: pa.Array) -> np.ndarray:
    """Log probability (words x languages), summed over all segmentations."""
    out = np.zeros((len(words), probs.shape[1]))
    data, offsets = _packed(words)
    lens_all = offsets[1:] - offsets[:-1]
    by_length = np.argsort(-lens_all, kind="stable")
    width, at = p.longest + 1, 0
    while at < len(by_length):
        # longest first; few words at a time while they are long
        step = int(max(1, min(8192, (1 << 21) // (int(lens_all[by_length[at]]) + 1))))
        order = by_length[at : at + step]
        at += step
        h, lens = _matrix(data, offsets, order)
        ring = np.zeros((width, len(order), probs.shape[1]))
        ring[0] = 1.0
        scale = np.zeros((len(order), probs.shape[1]))
        for k in range(1, int(lens[0]) + 1):
            n = int(np.searchsorted(-lens, -k, "right"))  # words of k bytes and more
            now = ring[k % width, :n]
            now[:] = 0.0
            for l in range(1, min(k, p.longest) + 1):
                rows = _find(p, h[k, :n] - h[k - l, :n] * p.powers[l])
                hit = np.flatnonzero(rows)
                if len(hit):
                    now[hit] += ring[(k - l) % width, hit] * probs[rows[hit]]
            if k % 8 == 0:  # keep the sums in range; the factor is remembered
                top = now.copy()
                top[top <= 0] = 1.0
                ring[:, :n] /= top
                scale[:n] += np.log(top)
            done = np.arange(int(np.searchsorted(-lens, -k, "left")), n)
            if len(done):
                out[order[done]] = np.log(ring[k % width, done] + 1e-300) + scale[done]
    return out


def _arcs(p: Pieces, h: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces that end at byte k of the first n words: start, word and row."""
    lens = np.arange(1, min(k, p.longest) + 1)
    rows = _find(p, (h[k, :n] - h[k - lens, :n] * p.powers[lens][:, None]).ravel())
    hit = np.flatnonzero(rows)
    return k - 1 - hit // n, hit % n, rows[hit]


def expected_counts(p: Pieces, probs: np.ndarray, words: pa.Array, weight: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (one language) in words of given weights:
    forward sums, then the share of every boundary from the end backward."""
    data, offsets = _packed(words)
    counts = np.zeros(p.n)
    lens_all = offsets[1:] - offsets[:-1]
    by_length = np.argsort(-lens_all, kind="stable")
    at = 0
    while at < len(by_length):
        # longest first; few words at a time while they are long
        step = int(max(1, min(8192, (1 << 21) // (int(lens_all[by_length[at]]) + 1))))
        order = by_length[at : at + step]
        at += step
        h, lens = _matrix(data, offsets, order)
        most = int(lens[0])
        active = np.searchsorted(-lens, -np.arange(most + 1), "right")  # words of k bytes and more
        a = np.zeros((most + 1, len(order)))
        a[0] = 1.0
        tops = {}
        for k in range(1, most + 1):
            n = int(active[k])
            start, word, rows = _arcs(p, h, k, n)
            a[k, :n] = np.bincount(word, a[start, word] * probs[rows], n)
            if k % 8 == 0:  # keep the sums in range; the way back takes the factor out again
                tops[k] = np.where(a[k, :n] > 0, a[k, :n], 1.0)
                a[max(0, k - p.longest + 1) : k + 1, :n] /= tops[k]
        g = np.zeros_like(a)
        g[lens, np.arange(len(order))] = weight[order]
        for k in range(most, 0, -1):
            n = int(active[k])
            if k % 8 == 0:
                a[max(0, k - p.longest + 1) : k + 1, :n] *= tops.pop(k)
            share = np.where(a[k, :n] > 0, g[k, :n] / np.where(a[k, :n] > 0, a[k, :n], 1.0), 0.0)
            start, word, rows = _arcs(p, h, k, n)
            flow = a[start, word] * probs[rows] * share[word]
            g[start, word] += flow
            np.add.at(counts, rows, flow)
    return counts


def split_words(texts: pa.Array) -> pa.Array:
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.string())))
    return lists


def learn(sample: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities (pieces x languages) from rows
    (lang, text)."""
    langs: list[str] = []
    probs = pieces.start[:, None]
    spark = sample.sparkSession
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, langs, probs))

        def run(batches):
            p, known, table_ = shared.value
            for batch in batches:
                for lang in pc.unique(batch.column("lang")).to_pylist():
                    texts = batch.filter(pc.equal(batch.column("lang"), lang))
                    for part in runs(texts, "text"):
                        coded = split_words(part.column("text")).flatten()
                        counted = pc.value_counts(coded.filter(pc.not_equal(coded, "")))
                        column = known.index(lang) if known else 0
                        c = expected_counts(
                            p, table_[:, column], counted.field("values"),
                            counted.field("counts").to_numpy(zero_copy_only=False).astype(float),
                        )
                        rows = np.flatnonzero(c)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(rows), pa.string()), pa.array(rows, pa.int32()), pa.array(c[rows])],
                            ["lang", "piece", "n"],
                        )

        counts = (
            sample.mapInArrow(run, "lang string, piece int, n double")
            .groupBy("lang", "piece")
            .agg(F.sum(F.round("n", 6).cast("decimal(24,6)")).cast("double").alias("n"))
            .toPandas()
        )
        langs = sorted(set(counts["lang"]))
        probs = np.zeros((pieces.n, max(1, len(langs))))
        for j, lang in enumerate(langs):
            own = counts[counts["lang"] == lang]
            probs[own["piece"].to_numpy(), j] = own["n"].to_numpy()
            probs[:, j] += 200.0 * pieces.start  # unseen pieces keep a little
            probs[0, j] = 0.0
            probs[:, j] /= probs[:, j].sum()
    return langs, probs


def predict(
    df: DataFrame, langs: list[str], probs: np.ndarray, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (the language's share of
    the text's total probability, all languages equally likely before).

    'und' with score 0 if the text is null or has no letter, or if nothing was
    learned.  Equal texts get equal results; ids may be null or repeated;
    other columns are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast((pieces, langs, probs))

    def run(batches):
        p, names, table_ = shared.value
        for batch in batches:
            for part in runs(batch, "text", 16 << 20):
                texts = pc.fill_null(part.column("text"), "").cast(pa.string())
                letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
                lists = split_words(texts)
                coded = lists.flatten().dictionary_encode()
                pred, score = np.full(part.num_rows, "und", object), np.zeros(part.num_rows)
                if names and len(coded):
                    ll = forward(p, table_, coded.dictionary)
                    ll[pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)] = 0.0
                    per_word = ll[coded.indices.to_numpy(zero_copy_only=False)]
                    doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                    total = np.stack(
                        [np.bincount(doc, per_word[:, j], part.num_rows) for j in range(len(names))], axis=1
                    )
                    total -= total.max(axis=1, keepdims=True)
                    share = np.exp(total)
                    share /= share.sum(axis=1, keepdims=True)
                    best = share.argmax(axis=1)
                    pred = np.where(letters, np.array(names, object)[best], "und")
                    score = np.where(letters, share[np.arange(len(best)), best], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(pred.tolist(), pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame, path: str = MODEL, per_lang: int = SAMPLE) -> DataFrame:
    """Learn from documents outside the fold, predict every document."""
    fold = crc_fold(F.col("doc_id"), 4)
    seen = cut(sample_labelled(docs.where(fold != 2), "doc_id", "lang", per_lang))
    sample = join_lookup(
        docs.select("doc_id", "text"), seen, F.col("doc_id") == F.col("sample_id"), "inner", 10**6
    ).select(F.col("sample_label").alias("lang"), "text")
    pieces = load_pieces(path)
    langs, probs = learn(cut(sample), pieces)
    return predict(docs, langs, probs, pieces).select(
        "doc_id", (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
