"""Token ids in ORC files: run-length encoded integers, row indexes and Bloom
filters on the document id, read by stripes and pruned by metadata.

The documents are range partitioned and sorted by id, encoded by the public
tokenizer, and written by Spark's ORC writer, whose integer columns are
run-length encoded (version 2).  Each row holds its document's ids and where
they begin in its file; with the files' totals, a few numbers per file, every
stripe can be read by any task without the ones before it.
"""

from __future__ import annotations

import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import shared_path, table
from tallyhawk.llm.sentencepiece import gather
from tallyhawk.llm.sentencepiece import runs as text_runs
from tallyhawk.llm.words import strings, text_bytes

TOKENIZER, END_ID = "byte_bpe_50k.json", 2
#: Rows between two entries of the row index, bytes of a stripe before compression.
INDEX_ROWS, STRIPE_BYTES = 1000, 32 << 20
#: Bytes of text encoded at a time, stretches of text remembered by a process.
RUN_BYTES, REMEMBERED = 8 << 20, 500_000
#: Kinds of bytes: letter, digit, other printable ASCII, space; 0: unknown.
_LETTER, _DIGIT, _OTHER, _SPACE = 1, 2, 3, 4
_KINDS = np.zeros(256, np.uint8)
_KINDS[33:127] = _OTHER
_KINDS[48:58] = _DIGIT
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
_KINDS[32] = _SPACE
_ALONE = re.compile(r" ?\S+").fullmatch


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def splits_words(tokenizer) -> bool:
    """Whether the tokenizer is byte-level BPE with its usual pattern, which
    starts a piece at every change between letters, digits and other
    characters and at a space after any of them (but for an apostrophe and
    what follows it): no normalizer, no prefix space, and no added token that
    takes neighbouring characters."""
    import json

    spec = json.loads(tokenizer.to_str())
    pre = spec.get("pre_tokenizer") or {}
    return (
        pre.get("type") == "ByteLevel" and pre.get("use_regex") is True and not pre.get("add_prefix_space")
        and not spec.get("normalizer") and spec["model"].get("type") == "BPE"
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )


def word_edges(data: np.ndarray) -> np.ndarray:
    """Where such a tokenizer starts a piece in any case, as flags per byte.
    Two-byte letters of U+00C0-U+00FF count as letters; next to any other
    character that is not ASCII nothing is said."""
    kind = _KINDS[data]
    two = np.flatnonzero(data[:-1] == 0xC3)
    two = two[(data[two + 1] != 0x97) & (data[two + 1] != 0xB7)]
    kind[two] = kind[two + 1] = _LETTER
    here, before = kind[1:], kind[:-1]
    seen = (before > 0) & (before < _SPACE) & (here > 0) & (here != before)
    return np.concatenate([[False], seen & ((here == _SPACE) | (data[:-1] != ord("'")))])


class Encoder:
    """Ids of texts, the same as the tokenizers library gives for whole texts.
    Where the tokenizer allows it, the library is asked once per distinct
    stretch between two edges."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cuts = splits_words(self.tokenizer)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.odd = re.compile("|".join(map(re.escape, self.added))) if self.added else None
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self.known: dict[str, int] = {}  # stretch -> its number
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def forget(self, first: int, words: list[str]) -> None:
        """Forget the words learned from number ``first`` on."""
        for w in words:
            del self.known[w]
        self.flat, self.ends = self.flat[: self.ends[first]], self.ends[: first + 1]

    def stretches(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Distinct stretches, the number of each, first one of each text."""
        data, ends = text_bytes(texts)
        if not len(data):
            return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
        edge = np.zeros(len(data) + 1, bool)
        # an added token is looked for before anything is split
        if self.cuts and not any(pc.any(pc.match_substring(texts, t)).as_py() for t in self.added):
            edge[:-1] = word_edges(data)
        edge[ends] = True
        starts = np.flatnonzero(edge)
        coded = strings(data, starts, pa.string() if len(data) < 1 << 31 else pa.large_string()).dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(starts, ends)

    def learn(self, words: list[str]) -> None:
        """Ask the library for new stretches: many at a time with a line end
        between them where that changes nothing, the rest one by one."""
        plain, rest = [], words
        if self.cuts and self.line is not None:
            # no white space but for one space before the rest, no added token
            plain = [w for w in words if _ALONE(w) and not (self.odd and self.odd.search(w))]
            rest = [w for w in words if not _ALONE(w) or self.odd and self.odd.search(w)] if len(plain) < len(words) else []
        groups = ["\n".join(plain[i : i + 100]) for i in range(0, len(plain), 100)]
        flat, lens = [self.flat], []
        for e in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False):
            ids = np.array(e.ids, np.int32)
            gaps = np.flatnonzero(ids == self.line)
            lens.append(np.diff(np.concatenate([[-1], gaps, [len(ids)]])) - 1)
            flat.append(np.delete(ids, gaps))
        for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False):
            flat.append(np.array(e.ids, np.int32))
            lens.append([len(e.ids)])
        self.known.update(zip([*plain, *rest], range(len(self.known), len(self.known) + len(plain) + len(rest))))
        self.flat = np.concatenate(flat)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate([*lens, np.zeros(0, np.int64)]))]).astype(np.int64)

    def encode(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), ``end_id`` after each, and where each text's begin."""
        distinct, codes, firsts = self.stretches(texts)
        words, known, first = distinct.to_pylist(), self.known, len(self.known)
        new = [w for w in words if w not in known]
        self.learn(new)
        codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))[codes]
        flat, ends = self.flat, self.ends
        if end_id is not None:
            codes, firsts = np.insert(codes, firsts[1:], len(ends) - 1), firsts + np.arange(len(firsts))
            flat, ends = np.append(flat, np.int32(end_id)), np.append(ends, ends[-1] + 1)
        values, ends = gather(flat, ends, codes)
        if len(known) > REMEMBERED:  # full: what came first stays
            self.forget(first, new)
        return values, ends[firsts]


@functools.cache
def process_encoder(path: str) -> Encoder:
    """One per Python process: its next tasks know the stretches of those before."""
    return Encoder(path)


def encode_documents(df: DataFrame, path: str, end_id: int | None = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """part, at, doc_id, n_tokens, ids in ascending order of ids: ``part`` is
    the number of the file, ``at`` the ids before the document in it.

    Null ids come first; rows of one id are ordered by a hash of their text
    and may lie in several files, so no id needs one task.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("tie"))
    ordered = docs.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches):
        encoder, at, part_no = process_encoder(path), 0, TaskContext.get().partitionId()
        for batch in batches:
            for part in text_runs(batch, "text", RUN_BYTES):
                values, ends = encoder.encode(part.column("text"), end_id)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part_no, np.int32)), pa.array(ends[:-1] + at), part.column("doc_id"),
                        pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values)),
                    ],
                    ["part", "at", "doc_id", "n_tokens", "ids"],
                )
                at += int(ends[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"part int, at bigint, doc_id {kind}, n_tokens bigint, ids array<int>")


def write_tokens(df: DataFrame, path: str, tokenizer: str | None = None, end_id: int | None = END_ID,
                 id_col: str = "doc_id", text_col: str = "text",
                 index_rows: int = INDEX_ROWS, stripe_bytes: int = STRIPE_BYTES) -> None:
    """Write the ids of every row's whole text as ORC files below ``path``.

    A null or empty text has only the end id.  Repeated rows are written as
    often as they stand there; an empty table gives files without rows; other
    columns are not read, whatever their names.  The tokenizer's file must
    have the same place on every machine.
    """
    rows = encode_documents(df, tokenizer or tokenizer_path(), end_id, id_col, text_col)
    (
        rows.write.option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", str(index_rows)).option("orc.stripe.size", str(stripe_bytes))
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """part, at, doc_id, n_tokens, ids as written.  A filter on doc_id reaches
    the files: stripes and index entries whose range or Bloom filter exclude
    it are not read."""
    return spark.read.orc(path)


def document_digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the documents of whole files;
    each task reads the stripes it is given."""

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            ids = pc.if_else(pc.is_null(ids), pa.scalar([], ids.type), ids)
            raw = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))]).astype(np.int64)
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("part", "at", "doc_id", "n_tokens")), pa.array(crc, pa.int64())],
                ["part", "at", "doc_id", "n_tokens", "ids_crc32"],
            )

    # one row per file
    totals = rows.groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    read = rows.mapInArrow(run, f"part int, at bigint, doc_id {kind}, n_tokens bigint, ids_crc32 bigint")
    return read.join(files, "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return document_digests(read_tokens(spark, path))


#: The tokenizer can't be put in SQL; tests compare with the library's own ids.
ORACLE_SQL = None
