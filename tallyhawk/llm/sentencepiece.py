"""SentencePiece encoding and decoding: shared-prefix Viterbi.

Each task takes the distinct marked words of its batch, sorts them, and walks
the trie they form depth-first: the forward states of a common prefix are
computed once and reused by every word below it.  Pieces never span from a
letter to a following space mark, so a text's ids are those of its marked
words in order, and no shuffle is needed.

For a unigram model the forward state is the best score, as usual.  For a BPE
model the score of a path is its number of merges undone, which is minus
infinity unless every two neighbours are what BPE itself would leave side by
side; exactly one path per prefix survives, and it ends in the pieces that
BPE's merging gives (a sequence of pieces is BPE's result if and only if each
neighbouring pair is).  Results are therefore those of the public library.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, LongType

from tallyhawk.llm.common import table
from tallyhawk.llm.words import strings, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Texts of a task are handled in runs of about so many bytes; distinct words
#: and pairs are remembered across runs up to so many entries.
RUN_BYTES, WORDS, PAIRS = 4 << 20, 400_000, 500_000


@dataclass
class Model:
    """What encoding and decoding need, read from the public model file."""

    kind: str
    ids: dict[str, int]  # piece (with spaces for marks) -> id
    scores: dict[int, float]
    byte_ids: list[int]
    texts: list[bytes]  # id -> what it decodes to
    longest: int
    splits: dict[str, tuple[str, str]] = field(default_factory=dict)  # BPE: the last merge that makes a piece
    ranks: dict[str, int] = field(default_factory=dict)  # BPE: order of that merge
    endings: dict[str, int] = field(default_factory=dict)  # BPE: every ending of a piece -> id, -1 if it is none


def load_model(path: str = MODEL, kind: str = "bpe", proto: bytes | None = None) -> Model:
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_proto=proto) if proto else SentencePieceProcessor(model_file=path)
    ids, scores, byte_ids, texts = {}, {}, [0] * 256, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            texts.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            texts.append(b"")
        else:
            plain = piece.replace(MARK, " ")
            texts.append(plain.encode())
            ids[plain] = i
            scores[i] = sp.get_score(i)
    model = Model(kind, ids, scores, byte_ids, texts, max(map(len, ids), default=1))
    if kind == "bpe":
        order = {v: r for r, v in enumerate(sorted(set(scores.values()), reverse=True))}
        for piece, i in ids.items():
            if len(piece) > 1 and (last := _last_merge(piece, ids, scores)):
                model.splits[piece], model.ranks[piece] = last, order[scores[i]]
        for piece, i in ids.items():
            if len(piece) == 1 or piece in model.ranks:
                for at in range(1, len(piece)):
                    model.endings.setdefault(piece[at:], -1)
                model.endings[piece] = i
    return model


def _last_merge(piece: str, ids: dict, scores: dict) -> tuple[str, str] | None:
    """The two parts that BPE joins last when it makes this piece, None if it
    never does: the neighbouring pair of the best score is joined, leftmost
    first, until none is a piece."""
    parts = list(piece)
    while True:
        best, at = None, -1
        for i in range(len(parts) - 1):
            j = ids.get(parts[i] + parts[i + 1])
            if j is not None and (best is None or scores[j] > best):
                best, at = scores[j], i
        if at < 0:
            return None
        if len(parts) == 2:
            return parts[0], parts[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


#: Number that stands before the first piece, and first number of characters
#: that are no piece.
_BEGIN, _OTHER = (1 << 21) - 1, 1 << 19


class Encoder:
    """Ids of marked words, with the states of shared prefixes reused."""

    def __init__(self, model: Model):
        self.m = model
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}
        self.floor = min(model.scores.values(), default=0.0) - 10.0
        self.names = {i: p for p, i in model.ids.items()} | {_BEGIN: ""}
        self.others: dict[str, int] = {}

    def other(self, char: str) -> int:
        """Number of a character that is no piece."""
        n = self.others.setdefault(char, _OTHER + len(self.others))
        self.names[n] = char
        return n

    def side_by_side(self, key: int) -> bool:
        """Whether BPE leaves pieces a and b apart.  Their merges are undone
        from the latest back; if what then touches would have been joined
        before the merge just undone, they would not be apart (an equal rank
        goes to the pair on the left)."""
        a, b = self.names[key >> 21], self.names[key & _BEGIN]
        ranks, splits = self.m.ranks, self.m.splits
        limit, ok = 1 << 60, True
        while a:
            joined = ranks.get(a + b)
            if joined is not None and joined < limit:
                ok = False
                break
            ra, rb = ranks.get(a, -1), ranks.get(b, -1)
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                limit, a = ra, splits[a][1]
            else:
                limit, b = rb + 1, splits[b][0]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[key] = ok
        return ok

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        new = sorted({w for w in words if w not in self.words})
        if len(self.words) + len(new) > WORDS:
            self.words = {}
            new = sorted(set(words))
        size = max(map(len, new), default=0) + 1
        step = self._extend_bpe if self.m.kind == "bpe" else self._extend_unigram
        # of the prefix of length d: its last piece, where that starts, its score
        last_piece, starts, scores = [_BEGIN] * size, [0] * size, [0.0] * size
        last = ""
        for w in new:
            d, most = 0, min(len(w), len(last))
            while d < most and w[d] == last[d]:
                d += 1
            step(w, d, last_piece, starts, scores)
            last = w
            out, end = [], len(w)
            while end:
                out.append(last_piece[end])
                end = starts[end]
            out.reverse()
            if max(out) >= _OTHER:
                out = [j for i in out for j in ([i] if i < _OTHER else [self.m.byte_ids[b] for b in self.names[i].encode()])]
            self.words[w] = out
        return self.words

    def _extend_bpe(self, w: str, known: int, last_piece: list, starts: list, scores: list) -> None:
        endings, pairs = self.m.endings.get, self.pairs.get
        for end in range(known + 1, len(w) + 1):
            start = end - 1
            i = endings(w[start:end], -1)
            if i < 0:
                i = self.other(w[start])
            while True:
                if i >= 0:
                    key = last_piece[start] << 21 | i
                    ok = pairs(key)
                    if ok or (ok is None and self.side_by_side(key)):
                        last_piece[end], starts[end] = i, start
                        break
                start -= 1
                i = endings(w[start:end]) if start >= 0 else None
                if i is None:
                    raise AssertionError(f"no segmentation of {w[:end]!r}")

    def _extend_unigram(self, w: str, known: int, last_piece: list, starts: list, scores: list) -> None:
        ids, values = self.m.ids, self.m.scores
        for end in range(known + 1, len(w) + 1):
            best = None
            for start in range(max(0, end - self.m.longest), end):
                i = ids.get(w[start:end])
                if i is None and start < end - 1:
                    continue
                score = scores[start] + (self.floor if i is None else values[i])
                if best is None or score > best:
                    best = score
                    last_piece[end] = self.other(w[start]) if i is None else i
                    starts[end], scores[end] = start, score


def marked_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All marked words and the first one of each text: one space is put before
    the text, and each run of spaces starts a word.  An empty text has none."""
    marked = pc.binary_join_element_wise(pa.scalar(" "), texts, "")
    data, ends = text_bytes(pc.if_else(pc.equal(texts, ""), pa.scalar("", pa.string()), marked))
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20)
    edge[ends] = True
    starts = np.flatnonzero(edge)
    small = len(data) < 1 << 31
    return strings(data, starts, pa.string() if small else pa.large_string()), np.searchsorted(starts, ends)


def runs(batch: pa.RecordBatch, text: str, limit: int = RUN_BYTES, rows: int = 8192) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of text, ``rows`` rows at most."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit + np.arange(len(sizes)) // rows
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def gather(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated runs values[offsets[i]:offsets[i+1]] for i in index, with
    the offsets of the result."""
    lens = (offsets[1:] - offsets[:-1])[index]
    ends = np.cumsum(lens)
    out = np.concatenate([[0], ends])
    at = np.repeat(offsets[:-1][index] - out[:-1], lens) + np.arange(out[-1])
    return values[at], out


def encode_texts(texts: pa.Array, encoder: Encoder) -> pa.Array:
    """list<int32> of ids per text (null and empty texts: no ids)."""
    marked, firsts = marked_words(pc.fill_null(texts, "").cast(pa.string()))
    coded = marked.dictionary_encode()
    words = coded.dictionary.to_pylist()
    ids = encoder.encode_words(words)
    per_word = [ids[w] for w in words]
    flat = np.fromiter((i for x in per_word for i in x), dtype=np.int32)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in per_word], dtype=np.int64)]).astype(np.int64)
    values, ends = gather(flat, offsets, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
    return pa.ListArray.from_arrays(pa.array(ends[firsts].astype(np.int32)), pa.array(values, pa.int32()))


def decode_ids(ids: pa.Array, model: Model) -> list[str]:
    """Texts of lists of ids; bytes that are no UTF-8 become U+FFFD."""
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.combine_chunks()
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(counts, dtype=np.int64).tolist()
    out, start = [], 0
    for end in ends:
        raw = b"".join([model.texts[i] for i in flat[start:end].tolist()])
        out.append(raw.removeprefix(b" ").decode("utf-8", "replace"))
        start = end
    return out


def _columns(df: DataFrame, taken: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if c not in taken]


def encode(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with piece_ids (array of int) and n_pieces (long); columns of
    these names are replaced.

    Null and empty texts have no pieces.  A space mark that stands in the
    text itself is written as bytes, so that decoding returns every text
    exactly.  Equal texts get equal ids; an empty table stays empty.
    """
    keep = _columns(df, ("piece_ids", "n_pieces"))
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary

    def run(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in runs(batch, text_col):
                ids = encode_texts(part.column(text_col), encoder)
                n = pc.list_value_length(ids).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, ids, n], [*keep, "piece_ids", "n_pieces"])

    schema = df.select(*keep).schema.add("piece_ids", ArrayType(IntegerType())).add("n_pieces", LongType())
    return df.select(*keep).mapInArrow(run, schema)


def decode(df: DataFrame, model: Model, ids_col: str = "piece_ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids (null ids: empty text)."""
    keep = _columns(df, (out_col,))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = pa.array(decode_ids(part.column(ids_col), shared.value), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*keep, out_col])

    return df.select(*keep).mapInArrow(run, df.select(*keep).schema.add(out_col, "string"))


def encoded_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, piece_ids of every row, and whether decoding the ids
    gives the text back (round_trip).

    Null and empty texts have no pieces and decode to the empty text.  Repeated
    rows stay as often as they stand there; texts of any length and with any
    characters are encoded whole; an empty table gives an empty result; other
    columns are ignored, whatever their names.

    Both directions run in one pass, so that neither texts nor ids go back
    and forth between Spark and a second Python process."""
    shared = docs.sparkSession.sparkContext.broadcast(load_model(path))

    def run(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in runs(batch, "text"):
                ids = encode_texts(part.column("text"), encoder)
                back = pa.array(decode_ids(ids, shared.value), pa.string())
                same = pc.equal(back, pc.fill_null(part.column("text"), "").cast(pa.string()))
                n = pc.list_value_length(ids).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), n, ids, same], ["doc_id", "n_pieces", "piece_ids", "round_trip"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_pieces bigint, piece_ids array<int>, round_trip boolean"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_documents(table(spark, sf_dir, "documents"))
