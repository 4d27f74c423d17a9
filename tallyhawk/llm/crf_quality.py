"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  Its own features and those of the lines before and
after it give the emission weights, two-by-two weights link neighbouring
labels, and forward-backward gives each line's probability of being good.  A
document's score is the mean of these, weighted by line length, passed through
a logistic curve that is fitted on the same sample.

The weights are learned on the driver from a bounded sample of whole labelled
documents (SAMPLE of each label), whose lines take the document's label.
Scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import crc_fold, cut, join_lookup, sample_labelled, table
from tallyhawk.llm.sentencepiece import runs

SAMPLE, STEPS, RATE, SHRINK = 1500, 150, 0.1, 1e-3
#: Byte classes whose share of a line is a feature.
_CLASSES = [
    bytes(range(65, 91)),  # A-Z
    b"0123456789",
    b"#$%&*@^~<>{}[]\\/=_+",
    b"|",
    b"!?",
    b".,;:",
    bytes(range(128, 256)),
    b" \t",
]
FEATURES = len(_CLASSES) + 9


@dataclass
class Weights:
    emit: np.ndarray  # (3 * FEATURES,): previous, own, next line; good against bad
    link: np.ndarray  # (2, 2)
    slope: float
    shift: float


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x FEATURES), lengths of lines in bytes plus one, and
    the number of lines of each text (an empty text has one empty line)."""
    lists = pc.split_pattern(pc.fill_null(texts, "").cast(pa.string()), "\n")
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    lines = lists.flatten()
    n = len(lines)
    doc = np.repeat(np.arange(len(counts)), counts)
    packed = pc.binary_join_element_wise(lines, pa.scalar(""), "").cast(pa.large_string())
    off = np.frombuffer(packed.buffers()[1], np.int64, n + 1, packed.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[: off[-1]]
    size = (off[1:] - off[:-1]).astype(float)
    out = np.zeros((n, FEATURES))
    for j, members in enumerate(_CLASSES):
        flag = np.zeros(256, np.int32)
        flag[list(members)] = 1
        sums = np.concatenate([[0], np.cumsum(flag[data])])
        out[:, j] = np.sqrt((sums[off[1:]] - sums[off[:-1]]) / np.maximum(size, 1))
    words = pc.ascii_split_whitespace(lines)
    per_line = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line = np.repeat(np.arange(n), per_line)
    again = np.zeros(len(code), bool)
    again[1:] = (code[1:] == code[:-1]) & (line[1:] == line[:-1])
    both = np.sort(line * (len(coded.dictionary) + 1) + code)
    fresh = np.ones(len(both), bool)
    fresh[1:] = both[1:] != both[:-1]
    w = np.maximum(per_line, 1)
    j = len(_CLASSES)
    out[:, j] = np.sqrt(np.bincount(line, again, n) / w)
    out[:, j + 1] = np.bincount(both[fresh] // (len(coded.dictionary) + 1), minlength=n)[:n] / w
    out[:, j + 2] = np.minimum(size / w / 10, 3)
    out[:, j + 3] = np.log1p(size) / 6
    out[:, j + 4] = size == 0
    out[:, j + 5] = per_line < 4
    same = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if n else np.zeros(0, np.int64)
    _, back, times = np.unique(doc * (n + 1) + same, return_inverse=True, return_counts=True)
    out[:, j + 6] = (times[back] > 1) & (size > 0)
    first = np.zeros(n, bool)
    first[np.cumsum(counts)[:-1]] = True
    if n:
        first[0] = True
    out[:, j + 7] = first
    out[:, j + 8] = 1.0
    return out, size + 1, counts


def with_neighbours(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of the previous, the own and the next line of the same text."""
    n, f = x.shape
    wide = np.zeros((n, 3 * f))
    wide[:, f : 2 * f] = x
    ends = np.cumsum(counts)
    start, end = np.zeros(n, bool), np.zeros(n, bool)
    start[(ends - counts)[counts > 0]] = True
    end[(ends - 1)[counts > 0]] = True
    wide[1:, :f] = x[:-1]
    wide[start, :f] = 0
    wide[:-1, 2 * f :] = x[1:]
    wide[end, 2 * f :] = 0
    return wide


def marginals(emit: np.ndarray, link: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all texts at once, line by line: probability of
    'good' per line, expected transitions (2 x 2) and log partition per text.
    ``emit`` is the log weight of good against bad."""
    n = len(emit)
    score = np.zeros((n, 2))
    score[:, 1] = emit
    order = np.argsort(-counts, kind="stable")
    first, lens = (np.cumsum(counts) - counts)[order], counts[order]
    a, b = np.zeros((n, 2)), np.zeros((n, 2))
    most = int(lens[0]) if len(lens) else 0
    active = [int(np.searchsorted(-lens, -k, "left")) for k in range(most)]  # texts of more than k lines
    for k in range(most):
        at = first[: active[k]] + k
        if k == 0:
            a[at] = score[at]
        else:
            before = a[at - 1]
            a[at] = score[at] + np.stack(
                [np.logaddexp(before[:, 0] + link[0, y], before[:, 1] + link[1, y]) for y in (0, 1)], axis=1
            )
    moves = np.zeros((2, 2))
    log_z = np.zeros(len(counts))
    whole = lens > 0
    last = first + lens - 1
    log_z[order[whole]] = np.logaddexp(a[last[whole], 0], a[last[whole], 1])
    z_line = np.repeat(log_z, counts)
    for k in range(most - 2, -1, -1):
        at = first[: active[k + 1]] + k
        after = b[at + 1] + score[at + 1]
        b[at] = np.stack([np.logaddexp(after[:, 0] + link[y, 0], after[:, 1] + link[y, 1]) for y in (0, 1)], axis=1)
        for y in (0, 1):
            for v in (0, 1):
                moves[y, v] += np.exp(a[at, y] + link[y, v] + after[:, v] - z_line[at]).sum()
    good = np.exp(a[:, 1] + b[:, 1] - z_line)
    return good, moves, log_z


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def doc_means(good: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    doc = np.repeat(np.arange(len(counts)), counts)
    total = np.bincount(doc, size, len(counts))
    return np.bincount(doc, good * size, len(counts)) / np.maximum(total, 1e-9)


def fit(x: np.ndarray, size: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Weights:
    """Maximum likelihood with a quadratic penalty, by Adam."""
    wide = with_neighbours(x, counts)
    y = np.repeat(labels.astype(float), counts)
    n_docs = max(1, len(counts))
    held = np.array([[np.maximum(counts[labels == 0] - 1, 0).sum(), 0.0], [0.0, np.maximum(counts[labels == 1] - 1, 0).sum()]])
    w = np.zeros(wide.shape[1] + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, STEPS + 1):
        link = w[-4:].reshape(2, 2)
        good, moves, _ = marginals(wide @ w[:-4], link, counts)
        g = np.concatenate([wide.T @ (y - good), (held - moves).ravel()]) / n_docs - SHRINK * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w + RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    good, _, _ = marginals(wide @ w[:-4], w[-4:].reshape(2, 2), counts)
    mean = doc_means(good, size, counts)
    slope, shift = 1.0, 0.0
    z = _logit(mean) / 4
    for _ in range(300):  # logistic curve of the mean, each label weighing the same
        p = 1 / (1 + np.exp(-(slope * z + shift)))
        share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
        slope += 2.0 * float((share * (labels - p) * z).sum())
        shift += 2.0 * float((share * (labels - p)).sum())
    return Weights(w[:-4], w[-4:].reshape(2, 2), slope / 4, shift)


def score_texts(texts: pa.Array, w: Weights) -> np.ndarray:
    x, size, counts = line_features(texts)
    good, _, _ = marginals(with_neighbours(x, counts) @ w.emit, w.link, counts)
    return 1 / (1 + np.exp(-(w.slope * _logit(doc_means(good, size, counts)) + w.shift)))


def learn(labelled: DataFrame) -> Weights | None:
    """Weights from rows (sample_id, sample_label, text); None without rows."""

    def run(batches):
        for batch in batches:
            for part in runs(batch, "text"):
                x, size, counts = line_features(part.column("text"))
                ends = np.cumsum(counts)
                rows = [
                    np.column_stack([size[e - c : e], x[e - c : e]]).astype(np.float32).tobytes()
                    for c, e in zip(counts, ends)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("sample_id"), part.column("sample_label"), pa.array(rows, pa.binary())],
                    ["sample_id", "sample_label", "lines"],
                )

    rows = (
        labelled.mapInArrow(run, "sample_id bigint, sample_label int, lines binary").orderBy("sample_id").toPandas()
    )
    if rows.empty:
        return None
    parts = [np.frombuffer(b, np.float32).reshape(-1, FEATURES + 1).astype(float) for b in rows["lines"]]
    both = np.concatenate(parts)
    return fit(both[:, 1:], both[:, 0], np.array([len(p) for p in parts]), rows["sample_label"].to_numpy())


def score_documents(df: DataFrame, weights: Weights | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and score (0 to 1, higher: good).

    Null and empty texts are one empty line and get the score the model gives
    that.  Without weights (nothing labelled) every score is 0.5.  Equal texts
    get equal scores; ids may be null or repeated; other columns are ignored.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if weights is None:
        return rows.select("doc_id", F.lit(0.5).alias("score"))

    def run(batches):
        for batch in batches:
            for part in runs(batch, "text"):
                score = pa.array(score_texts(part.column("text"), weights), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), score], ["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> Weights | None:
    """Learn from labelled documents outside the fold."""
    known = labels.where("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    picked = cut(sample_labelled(known.where(crc_fold(F.col("doc_id"), 3) != 1), "doc_id", "quality", per_label))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return learn(
        join_lookup(texts, picked, F.col("doc_id") == F.col("sample_id"), "inner").select(
            F.col("sample_id").cast("bigint").alias("sample_id"), "sample_label", "text"
        )
    )


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return score_documents(docs, train(docs, labels)).select(
        "doc_id",
        (crc_fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of the documents predicted good, each row judged on its own
    text as it passes through."""
    weights = train(docs, labels)
    if weights is None:
        return docs

    def run(batches):
        for batch in batches:
            for part in runs(batch, "text"):
                yield part.filter(pa.array(score_texts(part.column("text"), weights) >= 0.5))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
