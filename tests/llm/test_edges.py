"""Edges of the operators: odd ids, hostile texts and pages, small sites."""

import collections
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhawk.llm import common, exact_dedup, line_frequency, ngram_jaccard, sentencepiece, site_template, threshold_topk
from tallyhawk.llm.bloom import bloom_filter, inside
from tallyhawk.llm.common import table

PAGES = "page_id long, url string, html string, text string, template string, host string, hash string"


def text_of(html, **how):
    return site_template.Page(html, **how).text(set())


def test_names_never_take_article_text():
    kept = (
        '<h2 id="social-history">a</h2><p id="legal">b</p><section id="related-work">c</section><ul class="share-prices"><li>d</li></ul>'
        '<p class="notice">e</p><div id="side-effects">f</div><div class="navigation-history">g</div>'
    )
    assert text_of(f"<article>{kept}</article>").split("\n") == list("abcdefg")
    gone = (
        '<div class="adbox">x</div><div class="cookieNotice">x</div><div id="sidebar">x</div><div class="post-comments">x</div>'
        '<article class="comment">x</article><article class="related teaser">x</article><ul class="share-links"><li>x</li></ul>'
    )
    assert text_of(f"<main><p>own</p>{gone}</main>") == "own"
    assert text_of('<p>a <span class="ad">x <span>y</span> LEAK</span> b</p>') == "a b"
    assert text_of('<p>a <b class="ad">x <i><b>y</b></i> LEAK</b> b</p>') == "a b"


def test_hostile_and_long_pages_stay_linear():
    assert text_of("<div>" * 20000 + "t" + "</section>" * 20000) == "t"
    assert len(text_of("<p>word " * 50000)) > 200_000
    assert text_of("<p>a" + "</p>" * 50000 + "<p>b") == "a\nb"


def plain_extract(rows, share=0.5, least=3):
    """The two passes in plain Python."""
    host = lambda url: (re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "") or [None, ""])[1].lower()
    seen = collections.defaultdict(lambda: collections.defaultdict(set))
    for _, url, html in rows:
        if host(url):
            page = site_template.Page(html or "")
            key = page.key(page.digests())
            for h in {*page.digests(), *page.shapes(), b""}:
                seen[host(url)][h].add(key)
    templates = {
        h: {x for x, keys in by.items() if x and len(keys) >= least and len(keys) > share * len(by[b""])} for h, by in seen.items()
    }
    return {i: site_template.Page(html).text(templates.get(host(url), set())) if html else "" for i, url, html in rows}, templates


def test_op1_equals_the_plain_version(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.01", "pages").select("page_id", "url", "html").collect()]
    menus = "<body><ul class='m'><li>{0} a</li><li>b {0}</li></ul><div><p>own {0}</p><p>and more words of {0} here, a long text of its own</p></div></body>"
    rows += [(10_000 + i, f"http://menu.org/{i}", menus.format(i)) for i in range(5)]
    rows += [(10_100 + i, f"http://menu.org/{i}", menus.format(i)) for i in range(2)]  # repeated rows
    rows += [(None, None, None), (20_000, "http://menu.org/x", ""), (20_001, "http://long.org/", "<p>" + "w " * 100_000)]
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], PAGES)
    want, _ = plain_extract(rows)
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in site_template.extract_text(df).collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}
    assert got[10_003][0].startswith("own 3\n")  # the menu's words differ, its shape recurs
    assert site_template.extract_text(df.limit(0)).count() == 0


def test_templates_take_parts_of_the_given_pages(spark):
    """With the lists of tags, roles and names off, the template itself finds
    menus, adverts and footers of the given pages, and never the article."""
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.1", "pages").select("page_id", "url", "html").collect()]
    _, templates = plain_extract(rows[:1500])
    changed = spared = 0
    for _, url, html in rows[:1500]:
        host = re.match(r"[A-Za-z]+://([^/?#:]+)", url)
        template = templates.get(host[1].lower(), set()) if host else set()
        page = site_template.Page(html, lists=False)
        gone = page._gone(template, page.digests())
        changed += any(g and not s for g, s in zip(gone, page.skip))
        spared += not any(gone[n] for n in page.mains)
    assert changed > 100 and spared == 1500


def test_exact_dedup_keeps_one_row(spark):
    rows = [(1, "a b"), (1, "ab "), (2, "ab"), (3, "c"), (3, "c"), (3, "c"), (None, "d"), (None, "d")]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    kept = collections.Counter((r["keep_id"], r["text_sha256"]) for r in got if r["kept"])
    assert sorted(kept.values()) == [1, 1, 1] and len(kept) == 3
    assert {r["group_size"] for r in got if r["keep_id"] == 1} == {3}


def test_threshold_topk_rows_of_one_id(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, row string")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in threshold_topk.top_k(df, F.col("vec_id") == 0).collect())
    assert got == [(0, 1, 1, 65536), (0, 1, 1, 131072), (0, 2, 0, 0), (0, 2, 0, 0)]


def test_threshold_topk_large_scores(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-9, 9, 3) * 10.0**e]) for i, e in enumerate([0, 3, 6, 7, 8, 9, 12, 15, 18, 300] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [[max(-(2**63), min(2**63 - 1, int(x * 256))) for x in v] for _, v in rows]
    got = collections.defaultdict(dict)
    for r in threshold_topk.top_k(df, F.col("vec_id") % 5 == 0).collect():
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    for q in range(0, 30, 5):
        exact = [(sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in range(30) if i != q]
        scores = sorted((-max(-(2**63), min(2**63 - 1, s)), i) for s, i in exact)[:5]
        assert got[q] == {n: (i, -s) for n, (s, i) in enumerate(scores, 1)}


def test_threshold_topk_queries_of_a_block_read_in_step():
    rng = np.random.default_rng(3)
    m, ids = rng.integers(-40, 41, (2048, 64)), rng.permutation(2048)
    m[500:1500] = m[500]  # many copies: ties go to the smaller id
    rows = ids.astype(str).astype(object)
    began = time.thread_time()
    got = threshold_topk.threshold_top(ids, rows, m, rows[:1024], m[:1024], 5)
    assert time.thread_time() - began < 0.5  # a loop over the queries takes longer
    by = collections.defaultdict(list)
    for row, i, s in got:
        by[row].append((-s, i))
    scores = m[:1024] @ m.T
    for i in range(0, 1024, 9):
        order = np.lexsort((ids, -scores[i]))
        want = [(-scores[i, j], ids[j]) for j in order if j != i][:5]
        assert by[rows[i]] == want


def test_threshold_topk_some_queries_stop_early():
    rng = np.random.default_rng(4)
    m = np.sort(rng.integers(0, 9, (3000, 2)), axis=0)
    m[:40] += 1000
    q = np.concatenate([rng.integers(-3, 4, (30, 2)), np.zeros((2, 2), int)])
    ids = rng.permutation(3000)
    for scale in (1, 2**28, 2**40):  # float, 64-bit and beyond
        got = collections.defaultdict(list)
        for row, i, s in threshold_topk.threshold_top(ids, ids.astype(str).astype(object), m * scale, np.arange(32), q * (scale // 2**12 or 1), 3):
            got[row].append((-s, i))
        for n in range(32):
            exact = [(-max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) * scale * (scale // 2**12 or 1) for a, b in zip(q[n], v)))), i) for v, i in zip(m, ids)]
            assert got[n] == sorted(exact)[:3]


def test_sentencepiece_texts_with_every_character():
    every = "".join(map(chr, [*range(1, 32), *range(0xE000, 0xF900)])) + " a  b "
    model = sentencepiece.load_model()
    texts = [every, None, "", " ", "  x", "a b"]
    ids = sentencepiece.encode_texts(pa.array(texts, pa.string()), sentencepiece.Encoder(model))
    assert sentencepiece.decode_ids(ids, model) == [t or "" for t in texts]


def test_lines_of_sites_of_any_size(spark):
    def site(name, pages, on):
        return [(f"{name}{i}", ("menu\n" if i < on else "") + f"own {name} {i}", name) for i in range(pages)]

    rows = [*site("a", 3, 3), *site("b", 5, 2), *site("c", 60, 2), *site("d", 400, 9), *site("e", 400, 8), *site("f", 19, 19)]
    got = line_frequency.drop_frequent_lines(spark.createDataFrame(rows, "doc_id string, text string, source string"))
    dropped = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum("n_dropped").alias("n")).collect()}
    assert dropped == {"a": 3, "b": 0, "c": 0, "d": 9, "e": 0, "f": 19}


def test_line_frequency_sql_where_lines_go(spark, tmp_path):
    """The operator and its SQL on sites whose lines are dropped."""
    import duckdb

    rows = [(i, "".join(f"line {j}\n" for j in range(i % 7)) + f"own {i}\n \n", f"s{i % 5}" if i % 11 else None) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = line_frequency.query(spark, str(tmp_path))
    columns = ", ".join(got.columns)
    want = con.sql(f"SELECT {columns} FROM ({line_frequency.ORACLE_SQL}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in got.orderBy("doc_id").collect()] == want and sum(r[-1] for r in want) > 300


def test_jaccard_below_two_thirds_is_refused(spark):
    with pytest.raises(ValueError, match="2/3"):
        ngram_jaccard.jaccard_components(spark.createDataFrame([(1, "a")], "doc_id long, text string"), num=1, den=2)


@pytest.mark.parametrize("k, num, den", [(3, 9, 10), (5, 4, 5), (2, 2, 3)])
def test_linked_sets_share_the_keys_asked_for(k, num, den):
    rng, linked = np.random.default_rng(5), 0
    for n in [4, 9, 17, 40, 90, 250, 700, 1600]:
        for _ in range(12):
            words = [f"w{x}" for x in rng.integers(0, 10**6, n)]
            other = list(words)
            for at in rng.integers(0, n, rng.integers(1, 3 + n // 80)):
                other[at] = f"x{rng.integers(10**6)}"
            other = other[: n - rng.integers(0, 1 + n // 30)]
            value, offsets = ngram_jaccard.shingle_sets(pa.array([" ".join(words), " ".join(other)]), k)
            a, b = (set(value[x:y].tolist()) for x, y in zip(offsets, offsets[1:]))
            if a == b or len(a & b) * den < num * len(a | b):
                continue
            linked += 1
            _, key, place, least = ngram_jaccard.block_keys(value, offsets, num, den)
            shared = np.isin(key, np.intersect1d(key[place < 2], key[place >= 2]))
            enough = np.bincount(place[shared], minlength=4) >= least
            assert enough[:2].any() and enough[2:].any()
            # the band of the larger set is one of which both share enough
            bands = [(i, j) for i in (0, 1) for j in (2, 3) if np.intersect1d(key[place == i], key[place == j]).size]
            assert any(enough[i] and enough[j] for i, j in bands)
    assert linked > 20


def test_long_sets_are_linked_as_by_brute_force(spark):
    """Sets around 1024, 2048 and 4096 shingles: parities of one and of two lengths, and none."""
    rng, texts = np.random.default_rng(8), []
    for n in (1010, 1030, 2040, 2060, 4200):
        base = [f"w{x}" for x in rng.integers(0, 10**6, n)]
        for share in (0.0, 0.004, 0.01, 0.018, 0.03, 0.06):
            words = list(base)
            for at in rng.integers(0, n, int(n * share)):
                words[at] = f"x{rng.integers(10**6)}"
            texts.append(" ".join(words[rng.integers(0, 40) :]))
    value, offsets = ngram_jaccard.shingle_sets(pa.array(texts), 5)
    sets = [set(value[x:y].tolist()) for x, y in zip(offsets, offsets[1:])]
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) * 5 >= 4 * len(a | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = ngram_jaccard.jaccard_components(df, 5, 4, 5).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(root))
    assert 5 < len(set(root)) < len(root)
    # pairs that the parities judge: none that is linked goes, far ones do
    digests = ngram_jaccard._digests(value, offsets)
    pairs = [(digests[i], digests[j], 4 * (len(sets[i]) + len(sets[j]))) for i in range(len(sets)) for j in range(i)]
    rows = ngram_jaccard.set_rows(df.select("text"), 5)
    left = ngram_jaccard._finely_near(spark.createDataFrame(pairs, "a binary, b binary, need bigint"), rows, 4, 5)
    left = {(bytes(r["a"]), bytes(r["b"])) for r in left.collect()}
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) * 5 >= 4 * len(a | sets[j]):
                assert (digests[i], digests[j]) in left
            elif min(len(a), len(sets[j])) > 1024 and not a & sets[j] and max(len(a), len(sets[j])) < 2 * min(len(a), len(sets[j])):
                assert (digests[i], digests[j]) not in left


def test_bloom_filter_holds_all(spark):
    h = spark.range(50_000).select(F.xxhash64("id").alias("h"))
    bits = bloom_filter(h)
    own = np.array([r[0] for r in h.collect()], np.int64).view(np.uint64)
    other = np.array([r[0] for r in h.select(F.xxhash64("h")).collect()], np.int64).view(np.uint64)
    assert inside(bits, own).all() and inside(bits, other).mean() < 0.05
    assert not inside(bloom_filter(h.limit(0)), own).any()


def test_smallest_of_several_labels_counts(spark):
    rows = [(i % 4, "b" if i % 8 < 4 else "a") for i in range(16)]
    got = common.sample_labelled(spark.createDataFrame(rows, "id long, label string"), "id", "label", 100).collect()
    assert sorted(tuple(r) for r in got) == [(i, "a") for i in range(4)]


def test_ngram_jaccard_checkpoints_of_few_rows_are_few_files(spark, monkeypatch):
    """On many shuffle partitions a checkpoint has no file for each of them."""
    words = [f"w{i}" for i in range(60)]
    rows = [(10 * g + c, " ".join([f"g{g}", *words[:40], f"x{g}", *(f"{w}{g}" for w in words), "" if c == 0 else f"end{c}"])) for g in range(6) for c in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    files, kind = [], type(df)
    checkpoint = kind.checkpoint

    def counted(self, *args, **named):
        out = checkpoint(self, *args, **named)
        files.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(kind, "checkpoint", counted)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard.jaccard_components(df).collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == {10 * g + c: 10 * g for g in range(6) for c in range(4)}
    assert sum(n > common.tasks_for(0) for n in files) <= 10, files
