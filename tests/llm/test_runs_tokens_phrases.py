"""Periodic runs, token files and phrases against brute force and the public
library, and on nulls, empty and long texts, ties, repeated rows, empty tables
and clashing column names."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhawk.llm import periodic_runs, phrases, token_orc
from tallyhawk.llm.common import table

SF = "/root/testdata/sf0.001"
WHITE = "[\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, runs string, part int, at string, phrase string, rank int"


def words_of(text):
    return [w for w in re.split(WHITE, text or "") if w]


def brute_runs(w):
    """(start, length, period) by comparing the words at every lag."""
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            first = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if length >= max(24, 3 * q):
                found.setdefault((start, length), q)  # the smallest comes first
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        docs = []
        for _ in range(rng.randint(1, 4)):
            w = []
            for _ in range(rng.randint(0, 6)):
                unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 40))]
                w += (unit * rng.choice([1, 1, 2, 3, 5, 60]))[: rng.randint(1, 400)]
                w = w * 3 if rng.random() < 0.2 else w
            docs.append(w[:1200])
        codes = np.array([x for d in docs for x in d], np.int64)
        firsts = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        got = collections.defaultdict(list)
        for text, *run in zip(*periodic_runs.find_runs(codes, firsts)):
            got[int(text)].append(tuple(map(int, run)))
        assert [got[i] for i in range(len(docs))] == [brute_runs(d) for d in docs]


def test_runs_of_many_equal_words_stay_linear():
    codes = np.zeros(300_000, np.int64)
    assert [list(map(int, x)) for x in periodic_runs.find_runs(codes, np.array([0, 300_000]))] == [[0], [0], [300_000], [1]]


def test_op11_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in periodic_runs.query(spark, SF).collect()}
    assert got.keys() == docs.keys()
    with_runs = 0
    for doc_id, text in docs.items():
        w, h = words_of(text), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
        runs, r = brute_runs(w), got[doc_id]
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
        with_runs += bool(runs)
    assert with_runs > 5


def test_runs_edges(spark):
    twice = "a b " * 30 + "c " + "x y z " * 20
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "w " * 20000), (6, twice), (6, twice), (None, "é é\x0b" * 12), (7, "q " * 23)]
    df = spark.createDataFrame([(i, t, "en", "x", 1, "y", "z", 0) for i, t in rows], DOCS)
    got = collections.defaultdict(list)
    for r in periodic_runs.periodic_runs(df).collect():
        got[r["doc_id"]].append((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    assert got[1] == got[2] == got[3] == [(0, [], "")] and got[4] == [(2, [], "one two")]
    assert got[5] == [(20000, [(0, 20000, 1)], "w")] and got[7] == [(23, [], " ".join("q" * 23))]
    assert got[6] == [(121, [(0, 60, 2), (61, 60, 3)], "a b c x y z")] * 2 and got[None] == [(24, [(0, 24, 1)], "é")]
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0
    # of equal exponents the first run counts
    tied = spark.createDataFrame([(1, "a " * 24 + "b " * 24)], "doc_id long, text string")
    assert periodic_runs.digest(periodic_runs.periodic_runs(tied)).first()["start"] == 0


# ------------------------------------------------------------------ token files

ODD = [
    None, "", " ", "a", "  two  spaces ", "tab\t x\n\n y  ", "it's  John's 'll x", "naïve café — ü x", "nb  sp　 x   y", "a b c\u0085 d",
    "x<|endoftext|> y <|endoftext|>z", "😀 😀😀 a", "1234 56 7.8 , . ,", "a" * 3000 + " b", "é" * 500, "w " * 20000, "\x1c \x1d a", "ß ÷ × þ",
]


def test_stretches_give_the_library_ids():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_orc.tokenizer_path())
    encoder = token_orc.Encoder(token_orc.tokenizer_path())
    assert encoder.cuts
    rng = random.Random(5)
    alphabet = ["a", "B", " ", " ", "é", "\n", "\t", "1", ".", "'s", " ", "ü", "中", "😀", "　", "<|endoftext|>"]
    texts = [*ODD, *("".join(rng.choices(alphabet[:-1], k=rng.randint(0, 40))) for _ in range(2000)), *("".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(2000))]
    values, ends = encoder.encode(pa.array(texts[: len(ODD)], pa.string()), 2)
    for i, text in enumerate(ODD):
        assert values[ends[i] : ends[i + 1]].tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 2], text
    texts = [t for t in texts if t and "<|" not in t] + [t for t in texts if t and "<|" in t]  # with and without added tokens
    half = [("<|" in t) for t in texts].index(True)
    for part in (texts[:half], texts[half:]):
        values, ends = encoder.encode(pa.array(part, pa.string()), 2)
        for i, text in enumerate(part):
            assert values[ends[i] : ends[i + 1]].tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], text
    for text in texts:  # edges are where the library starts a token
        data = np.frombuffer(text.encode(), np.uint8)
        starts, at = set(), 0
        for token in library.pre_tokenizer.pre_tokenize_str(text):
            starts.add(at)
            at += len(token[0])  # one character stands for each byte
        assert set(np.flatnonzero(token_orc.word_edges(data)).tolist()) <= starts, text
    values, ends = encoder.encode(pa.array(texts, pa.string()), 2)
    for i, text in enumerate(texts[:500]):
        assert values[ends[i] : ends[i + 1]].tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 2], text
    whole = token_orc.Encoder(token_orc.tokenizer_path())
    whole.cuts = False  # other tokenizers: whole texts
    assert whole.encode(pa.array(texts[:500], pa.string()), None)[0].tolist() == encoder.encode(pa.array(texts[:500], pa.string()), None)[0].tolist()


def expected(rows, library):
    at, out = 0, []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_op12_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_orc.tokenizer_path())
    rows = sorted(tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in token_orc.query(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == expected(rows, library)


def test_token_files_edges(spark, workdir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_orc.tokenizer_path())
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "a"), (3, "a")]
    df = spark.createDataFrame([(i, t, "en", "x", 1, "y", "z", 0) for i, t in rows], DOCS)
    token_orc.write_tokens(df, f"{workdir}/t")
    got = sorted(tuple(r) for r in token_orc.document_digests(token_orc.read_tokens(spark, f"{workdir}/t")).collect())
    assert got == expected(sorted(rows, key=lambda r: r[0]), library)
    some = spark.createDataFrame([(None, "b c"), (1, "x"), (None, "b c")], "doc_id long, text string")
    token_orc.write_tokens(some, f"{workdir}/n")
    got = [tuple(r) for r in token_orc.document_digests(token_orc.read_tokens(spark, f"{workdir}/n")).orderBy("start").collect()]
    assert [(r[0], r[1], r[2]) for r in got] == [(None, 0, 3), (None, 3, 3), (1, 6, 2)]
    token_orc.write_tokens(df.limit(0), f"{workdir}/0")
    assert token_orc.document_digests(spark.read.schema("part int, at long, doc_id long, n_tokens long, ids array<int>").orc(f"{workdir}/0")).count() == 0


def scanned(spark, df):
    """Rows that the file scan of a query gave out."""
    df.collect()
    found, plan = [], df._jdf.queryExecution().executedPlan()
    todo = [plan]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.getClass().getName():
            node = node.executedPlan()
        if "FileSourceScanExec" in node.getClass().getName():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_token_files_are_pruned(spark, workdir):
    """A lookup reads one entry of the row index: range statistics exclude the
    others, and the Bloom filter a number in the range that no row has."""
    df = spark.range(0, 40000, 2).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of "), F.col("id")).alias("text")).coalesce(1)
    token_orc.write_tokens(df, f"{workdir}/t", index_rows=1000)
    tokens = token_orc.read_tokens(spark, f"{workdir}/t")
    hit = tokens.where("doc_id = 20000").select("doc_id", "n_tokens", "ids")
    assert len(hit.collect()) == 1 and 0 < scanned(spark, hit) <= 2000
    missing = [tokens.where(f"doc_id = {i}").select("n_tokens") for i in (20001, 333, 12345, 39001)]
    assert sum(scanned(spark, m) for m in missing) <= 1000
    # several stripes of one file are read by several tasks
    token_orc.write_tokens(df, f"{workdir}/s", index_rows=1000, stripe_bytes=1 << 14)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        read = token_orc.read_tokens(spark, f"{workdir}/s")
        assert read.rdd.getNumPartitions() > len(read.inputFiles())
        ends = token_orc.document_digests(read).agg(F.count("*"), F.max(F.col("start") + F.col("n_tokens")), F.sum("n_tokens")).first()
        assert ends[0] == 20000 and ends[1] == ends[2]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# ------------------------------------------------------------------ phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_phrases(rows, support=10, inside=50, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    out = collections.defaultdict(list)
    for (lang, *w), a in f.items():
        if len(w) < 2 or a < support:
            continue
        if len(w) == 2 and any(len(x) == 4 and x[0] == lang and 100 * f[x] >= inside * a and f[x] >= support
                               and (list(x[1:3]) == w or list(x[2:]) == w) for x in f):
            continue
        score, _, l, r = min(
            (1000000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))
        )
        out[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return {
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, found in out.items() for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)
    }


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_phrases_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["New", "york", "City", "a", "b", "c", "é", "É", "the", "of", "x\x1cy", "zß"]
    rows = []
    for _ in range(400):
        words = rng.choices(vocabulary, weights=[5, 5, 3, 4, 3, 2, 2, 2, 9, 6, 2, 2], k=rng.randint(0, 40))
        rows.append(("".join(w + rng.choice([" ", " ", "  ", "\t", ", ", "\n", ".", " "]) for w in words), rng.choice(["en", "de", None, "und"])))
    rows += [(None, "en"), ("", "fr"), ("New York " * 3000, "en"), (" . ,", None)] + [("twin words here", "fr")] * 12 + [("other pair", "fr")] * 12
    df = spark.createDataFrame([(i, t, g, "x", 1, "y", "z", 0) for i, (t, g) in enumerate(rows)], DOCS).repartition(7)
    want = brute_phrases(rows)
    got = {tuple(r) for r in phrases.collocations(df).select(*COLUMNS).collect()}
    assert got == want and {r[0] for r in got} >= {"en", "de", "und", "fr"}
    few = {tuple(r) for r in phrases.collocations(df, support=4, covered=80, top=5, shards=2).select(*COLUMNS).collect()}
    assert few == brute_phrases(rows, 4, 80, 5)
    assert phrases.collocations(df.limit(0)).count() == 0


def test_shards_lose_no_phrase(spark):
    """Words spread so that each shard has as few as possible are still found."""
    for support, shards in ((10, 3), (10, 4), (7, 3), (10, 1), (5, 9)):
        assert shards * (phrases.local_threshold(support, shards) - 1) < support
    df = spark.createDataFrame([("thin spread",)] * 10 + [("alone",)], "text string").withColumn("lang", F.lit("en")).repartition(11)
    assert [r["phrase"] for r in phrases.collocations(df).collect()] == ["thin spread"]


def test_scores_of_large_counts_are_exact(spark):
    big = 3_000_000_000_000
    rows = [("en", 0, "", 10 * big), ("en", 1, "p", big + 7), ("en", 1, "q", big + 11), ("en", 2, "p q", big)]
    got = phrases.scored_phrases(spark.createDataFrame(rows, "lang string, k int, phrase string, f long")).first()
    assert got["score"] == 1000000 * big * big // ((big + 7) * (big + 11))


def test_a_full_filter_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(phrases, "bloom_filter", lambda hashes: np.full(1 << 17, 255, np.uint8))
    rows = [("alpha beta gamma " * 12, "en"), ("alpha beta delta", "en")]
    got = {tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, "text string, lang string")).select(*COLUMNS).collect()}
    assert got == brute_phrases(rows)


def test_phrase_mining_holds_no_table_of_a_tasks_phrases(spark):
    """Counts of a run of texts are dealt out as they are, and summed once."""
    docs = spark.createDataFrame([("a b c a b", "en")] * 12, "text string, lang string")
    mined = phrases.frequent_hashes(docs, 10, 3)
    plan = mined._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning", 1)[1]
    assert "HashAggregate" not in below and plan.count("Exchange hashpartitioning") == 1
    assert mined.count() == 6  # a, b, c, a b, b c, c a
    assert phrases._RUN <= 1 << 20
