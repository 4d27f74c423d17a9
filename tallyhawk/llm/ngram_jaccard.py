"""N-gram Jaccard join with a count-vector R-tree.

A document is the set of its distinct word shingles (64-bit hashes); equal
sets are one class from the start.  Shingles are hashed into COORDS groups and
the counts per group are a point.  Two points bound the overlap of their sets
by the sum of the smaller coordinates, and an R-tree over points bounds it for
whole subtrees by the largest coordinates below.  Points that pass are bounded
once more by counts modulo 2 in many more groups (a group of odd difference
holds a shingle that only one set has); sets of more than BITS shingles, of
which those groups say little, once more in as many groups as they have
shingles.  Survivors are verified on the sets.

So that no task needs all points, the search runs inside blocks that no link
can miss.  Linked sets of a size band differ in at most r shingles.  Shingles
are dealt into more than r parts by hash; a part without a difference holds
the same shingles in both, so the two sets share the block (band, part,
content).  Parts that are empty in both make large blocks and are needed only
by sets with r or fewer non-empty parts: of a set with more, some non-empty
part must be free of differences.  By the same count a set with f > r non-empty
parts shares f - r keys of the band with every set it is linked with, so one of
which fewer keys occur again is left out of the search.

Components need no list of all links.  Each block first tests its members
against its smallest one; whatever still spans several components is searched
by the R-tree, cut into sub-blocks of BLOCK points.  A round returns at most a
few best partners of each point and says if there were more; rounds go on,
eight times wider each, until nothing was left out.  The result is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.bloom import bloom_filter, inside
from tallyhawk.llm.common import components, cut, gathered, join_lookup, release, stored, table, tasks_for
from tallyhawk.llm.sentencepiece import runs

#: Coordinates of a point, members of a leaf or node, points of a sub-block,
#: partners returned for a point by the first round.
COORDS, FANOUT, BLOCK, PARTNERS = 64, 16, 2048, 4
#: Bytes of text whose shingles are in a task's memory at a time.
SET_BYTES = 1 << 20
#: Pairs of digests (40 bytes each) up to which they are broadcast.
NAMED = 200_000
#: Slices in which the sets of the pairs to verify travel.
SLICES = 4
#: Groups whose counts are kept modulo 2.
BITS = 1024
_BAND = 1.5
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C[1]
    x = (x ^ (x >> np.uint64(27))) * _C[2]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each text, and
    their offsets.  A text of fewer than k words has its whole sequence as one
    shingle; a text without words has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "").cast(pa.string())))
    n = len(lists)
    doc = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    code = coded.indices.to_numpy(zero_copy_only=False)
    full = (np.fromiter(map(len, words), np.int64, len(words)) > 0)[code] if len(code) else np.zeros(0, bool)
    doc, h = doc[full], hashes[code[full]] if len(code) else np.zeros(0, np.uint64)
    counts = np.bincount(doc, minlength=n)
    size = len(h)
    s = h.copy()
    for j in range(1, k if size >= k else 1):
        s[: size - j] = _mix(s[: size - j] * _C[0] + h[j:])
    whole = np.zeros(max(0, size - k + 1), bool)
    if size >= k:
        whole = doc[: size - k + 1] == doc[k - 1 :]
    at = np.flatnonzero(whole)
    owner, value = doc[at], s[at]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        ends = np.cumsum(counts)
        few = []
        for d in short:
            run = h[ends[d] - counts[d] : ends[d]]
            v = np.array([counts[d]], np.uint64)
            for x in run:
                v = _mix(v * _C[3] + x)
            few.append(v[0])
        owner, value = np.concatenate([owner, short]), np.concatenate([value, np.array(few, np.uint64)])
    value = _mix(value + _C[0])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    owner, value = owner[fresh], value[fresh]
    return value, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int64)


def bands(num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last size of each band, the differences r that linked sets
    with the larger one in the band can have, and the parts to deal into."""
    first, last = [1], []
    while first[-1] < 1 << 40:
        last.append(int(first[-1] * _BAND))
        first.append(last[-1] + 1)
    low, high = np.array(first[:-1]), np.array(last)
    r = 2 * high * (den - num) // (den + num)
    return low, high, r, r + 4 + (r * 12 + 99) // 100


def block_keys(
    value: np.ndarray, offsets: np.ndarray, num: int, den: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, block key, place of the key's (text, band)) of all texts,
    and by place the keys that linked sets of the band share at least."""
    sizes = offsets[1:] - offsets[:-1]
    low, high, r_of, parts_of = bands(num, den)
    band = np.searchsorted(high, sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    owners, keys, places = [], [], []
    least = np.ones(2 * len(sizes), np.int64)
    for up in (0, 1):
        tag = band + up
        use = (sizes > 0) & (r_of[tag] > 0)
        if up:  # only sets that a set of the next band can be linked with
            use &= sizes * den // num >= low[tag]
        picked = use[owner]
        own, v = owner[picked], value[picked]
        if not len(v):
            continue
        t = tag[own].astype(np.uint64)
        m = parts_of[tag[own]].astype(np.uint64)
        part = ((v >> np.uint64(32)) * m) >> np.uint64(32)
        begins = np.ones(len(v), bool)
        begins[1:] = (own[1:] != own[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(begins)
        content = np.add.reduceat(_mix(v + _C[3]), at)
        keys.append(_mix(content + _mix(part[at] * _C[0] + t[at] * _C[3] + np.uint64(1))))
        owners.append(own[at])
        places.append(2 * own[at] + up)
        filled, t_of = np.bincount(own[at], minlength=len(sizes)), tag.astype(np.uint64)[:, None]
        least[up::2] = np.maximum(1, filled - r_of[tag])
        for d in np.flatnonzero(use & (filled <= r_of[tag])):
            here = part[at][own[at] == d].astype(np.int64)
            rest = np.setdiff1d(np.arange(parts_of[tag[d]]), here).astype(np.uint64)
            keys.append(_mix(_mix(rest * _C[0] + t_of[d] * _C[3] + np.uint64(1))))
            owners.append(np.full(len(rest), d))
            places.append(np.full(len(rest), 2 * d + up))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), least
    owner, key, place = np.concatenate(owners), np.concatenate(keys).view(np.int64), np.concatenate(places)
    order = np.argsort(owner, kind="stable")
    return owner[order], key[order], place[order], least


def _digests(value: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    return [hashlib.md5(value[a:b].tobytes()).digest() if b > a else None for a, b in zip(offsets, offsets[1:])]


def _did(digests: list[bytes | None]) -> pa.Array:
    """The first 64 bits of the digests."""
    return pa.array([int.from_bytes(d[:8], "little", signed=True) if d else None for d in digests], pa.int64())


def signed_documents(df: DataFrame, k: int) -> DataFrame:
    """doc_id, n, digest (of the set, null if empty) and did (its first 64 bits)."""

    def run(batches):
        for batch in batches:
            for part in runs(batch, "text", SET_BYTES):
                value, offsets = shingle_sets(part.column("text"), k)
                digests = _digests(value, offsets)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(offsets[1:] - offsets[:-1], pa.int64()), pa.array(digests, pa.binary()), _did(digests)],
                    ["doc_id", "n", "digest", "did"],
                )

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(run, f"doc_id {kind}, n bigint, digest binary, did bigint")


def keyed_sets(df: DataFrame, k: int, num: int, den: int, known: np.ndarray | None = None) -> DataFrame:
    """The block keys of the texts' sets: each key alone, or, given the filter
    of those that occur again, (did, key) of the sets and bands with as many
    of them as a link takes.  A set that its task has just seen is left out."""
    shared = None if known is None else df.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        seen: set = set()
        for batch in batches:
            for part in runs(batch, "text", SET_BYTES):
                value, offsets = shingle_sets(part.column("text"), k)
                digests = _digests(value, offsets)
                if len(seen) > 500_000:
                    seen.clear()
                fresh = np.zeros(len(digests), bool)
                for i, d in enumerate(digests):
                    if d and d not in seen:
                        seen.add(d)
                        fresh[i] = True
                owner, key, place, least = block_keys(value, offsets, num, den)
                use = fresh[owner]
                if shared is not None:
                    use[use] = inside(shared.value, key[use].view(np.uint64))
                    use &= (np.bincount(place[use], minlength=len(least)) >= least)[place]
                owner, key = owner[use], pa.array(key[use])
                yield pa.RecordBatch.from_arrays([key] if shared is None else [_did(digests).take(pa.array(owner)), key],
                                                 ["key"] if shared is None else ["did", "key"])

    return df.select("text").mapInArrow(run, "key bigint" if known is None else "did bigint, key bigint")


def parities(value: np.ndarray) -> np.ndarray:
    """Of a set of more than BITS hashes the counts modulo 2 in the first power
    of two of groups that is no less than its size, packed; else nothing."""
    if len(value) <= BITS:
        return np.zeros(0, np.int64)
    groups = 1 << (len(value) - 1).bit_length()
    odd = np.bincount((_mix(value + _C[2]) & np.uint64(groups - 1)).astype(np.int64), minlength=groups) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_rows(df: DataFrame, k: int) -> DataFrame:
    """digest, did, n, point (counts per coordinate), bits (parities), fine
    (those of large sets in more groups) and hashes of the texts."""

    def run(batches):
        for batch in batches:
            for part in runs(batch, "text", SET_BYTES, 2048):
                value, offsets = shingle_sets(part.column("text"), k)
                digests = _digests(value, offsets)
                sizes = offsets[1:] - offsets[:-1]
                owner = np.repeat(np.arange(len(sizes)), sizes)
                points = np.bincount(
                    owner * COORDS + (_mix(value) >> np.uint64(58)).astype(np.int64), minlength=len(sizes) * COORDS
                )
                odd = np.bincount(owner * BITS + (_mix(value + _C[1]) % np.uint64(BITS)).astype(np.int64), minlength=len(sizes) * BITS)
                bits = np.packbits((odd & 1).astype(np.uint8)).view(np.int64)
                fine = [parities(value[a:b]) for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(digests, pa.binary()),
                        _did(digests),
                        pa.array(sizes, pa.int64()),
                        pa.FixedSizeListArray.from_arrays(pa.array(points, pa.int32()), COORDS).cast(pa.list_(pa.int32())),
                        pa.FixedSizeListArray.from_arrays(pa.array(bits), BITS // 64).cast(pa.list_(pa.int64())),
                        pa.array(fine, pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(value.view(np.int64))),
                    ],
                    ["digest", "did", "n", "point", "bits", "fine", "hashes"],
                )

    return df.mapInArrow(run, "digest binary, did bigint, n bigint, point array<int>, bits array<bigint>, fine array<bigint>, hashes array<bigint>")


class Tree:
    """R-tree packed over points sorted by size, then by coordinate sums: per
    level the largest coordinates and the smallest size of each node."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        half = points[:, : COORDS // 2].sum(axis=1)
        self.order = np.lexsort((half, np.round(np.log(sizes) * 40)))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = [(self.points, self.sizes)]
        while len(self.levels[-1][0]) > FANOUT:
            high, least = self.levels[-1]
            starts = np.arange(0, len(high), FANOUT)
            self.levels.append((np.maximum.reduceat(high, starts), np.minimum.reduceat(least, starts)))

    def search(self, point: np.ndarray, size: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the points whose overlap bound allows a link, and the bounds."""
        at = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            high, least = self.levels[level]
            bound = np.minimum(high[at], point).sum(axis=1)
            ok = bound * (num + den) >= num * (size + least[at])
            at, bound = at[ok], bound[ok]
            if level:
                below = len(self.levels[level - 1][0])
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < below]
        return self.order[at], bound


def partners(group: dict, num: int, den: int, most: int) -> tuple[list, list, list]:
    """Pairs (asking, found, whether more were left out) of one sub-block."""
    roots, digests, sizes, bits = group["root"], group["digest"], group["n"], group["bits"]
    ask, have = np.flatnonzero(group["asks"]), np.flatnonzero(group["has"] & ~group["pivot"])
    a, b, more = [], [], []
    if len(ask) and len(have):
        tree = Tree(group["point"][have], sizes[have])
        for i in ask:
            found, bound = tree.search(group["point"][i], sizes[i], num, den)
            found = have[found]
            both = sizes[i] + sizes[found]
            apart = np.bitwise_count(bits[found] ^ bits[i]).sum(axis=1, dtype=np.int64)
            ok = (roots[found] != roots[i]) & ((both - apart) * (num + den) >= 2 * num * both)
            found, apart = found[ok], apart[ok]
            if len(found):
                best = np.argsort(apart, kind="stable")[:most]
                a += [digests[i]] * len(best)
                b += list(digests[found[best]])
                more += [len(found) > most] * len(best)
    return a, b, more


def _verified(pairs: DataFrame, points: DataFrame, sets: DataFrame, num: int, den: int, n: int) -> DataFrame:
    """The linked ones of the pairs (a, b) of digests: overlap bound on the
    points first, then the sets."""

    def side(df, name, *cols):
        return df.select(F.col("digest").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in cols])

    near = (
        pairs.join(side(points, "a", "n", "point", "bits"), "a")
        .coalesce(n)
        .join(side(points, "b", "n", "point", "bits"), "b")
        .withColumn("need", F.lit(num) * (F.col("n_a") + F.col("n_b")))
    )
    bound = F.aggregate(F.zip_with("point_a", "point_b", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda t, x: t + x)
    apart = F.aggregate(
        F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0).cast("long"), lambda t, x: t + x
    )
    near = near.where(bound * (num + den) >= F.col("need")).where(
        (F.col("n_a") + F.col("n_b") - apart) * (num + den) >= 2 * F.col("need")
    ).select("a", "b", "need").coalesce(n)
    near = gathered(_finely_near(cut(near), sets, num, den), n)
    release(near.sparkSession)
    # the sets of a slice of the pairs travel at a time, so that the disk holds
    # one slice's shuffle; every pair lies in one slice
    linked = None
    for i in range(SLICES):
        part = near.where(F.pmod(F.xxhash64("b"), F.lit(SLICES)) == i)
        same = gathered(_same_sets(part, sets, num, den, n), n)
        release(near.sparkSession)
        linked = same if linked is None else linked.unionByName(same)
    return linked


def _finely_near(near: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b, need) that the parities of large sets leave.  Sizes of
    linked sets differ by less than a half, so the longer parities are at most
    twice the others and are folded once: group g and g + half become one."""

    def side(name):
        return sets.select(F.col("digest").alias(name), F.col("fine").alias(f"fine_{name}"))

    def folded(x, size):
        half = (F.size(x) / 2).cast("int")
        halves = F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(x) > size, halves).otherwise(x)

    size = F.least(F.size("fine_a"), F.size("fine_b"))
    both = near.join(side("a"), "a").join(side("b"), "b").withColumn("x", folded(F.col("fine_a"), size)).withColumn("y", folded(F.col("fine_b"), size))
    apart = F.aggregate(
        F.zip_with("x", "y", lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0).cast("long"), lambda t, v: t + v
    )
    ok = (F.col("need") - num * apart) * (num + den) >= 2 * num * F.col("need")
    return both.where((F.size("x") != F.size("y")) | ok).select("a", "b", "need")


def _same_sets(near: DataFrame, sets: DataFrame, num: int, den: int, n: int) -> DataFrame:
    """The pairs (a, b, need) whose sets share enough."""
    hashes = sets.select("digest", "hashes")
    # a set travels once per pair it is the first of; of the second ones only
    # those named travel
    first = join_lookup(hashes.withColumnRenamed("digest", "a").withColumnRenamed("hashes", "hashes_a"), near, "a", "inner", NAMED)
    named = cut(near.select(F.col("b").alias("digest")).distinct().coalesce(n))
    second = join_lookup(hashes, named, "digest", "left_semi", NAMED).select(F.col("digest").alias("b"), F.col("hashes").alias("hashes_b"))
    both = first.join(second, "b")  # whole sets: no fewer tasks
    same = F.size(F.array_intersect("hashes_a", "hashes_b"))
    return both.where(same * (num + den) >= F.col("need")).select("a", "b")


def _search_round(blocks: DataFrame, points: DataFrame, num: int, den: int, most: int, n: int) -> DataFrame:
    """R-tree search inside the blocks (key, digest, pivot, root, asks): pairs (a, b) of different components and whether some were left out."""
    # the number of sub-blocks is known before the points are attached
    parts = blocks.groupBy("key").agg(F.ceil(F.count("*") / F.lit(float(BLOCK))).cast("int").alias("parts"))
    sized = (
        blocks.join(parts, "key").coalesce(n).join(points, "digest").coalesce(n)
        .withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))
    )
    cols = ["key", "digest", "n", "point", "bits", "pivot", "root"]
    # each sub-block of members meets each sub-block of those that ask
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    whole = sized.where("parts = 1").select(
        *cols, F.lit(0).alias("i"), F.lit(0).alias("j"), "asks", F.lit(True).alias("has")
    )
    split = sized.where("parts > 1")
    asking = split.where("asks").select(
        *cols, F.col("part").alias("i"), F.explode(every).alias("j"), F.lit(True).alias("asks"), F.lit(False).alias("has")
    )
    having = split.select(
        *cols, F.explode(every).alias("i"), F.col("part").alias("j"), F.lit(False).alias("asks"), F.lit(True).alias("has")
    )
    dealt = whole.unionByName(asking).unionByName(having).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches):
        held: list[pa.RecordBatch] = []

        def answer(parts):
            rows = pa.Table.from_batches(parts).combine_chunks()
            group = {
                "asks": rows.column("asks").to_numpy(), "has": rows.column("has").to_numpy(),
                "pivot": rows.column("pivot").to_numpy(),
                "bits": rows.column("bits").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, BITS // 64).view(np.uint64),
                "n": rows.column("n").to_numpy(), "root": np.array(rows.column("root").to_pylist(), object),
                "digest": np.array(rows.column("digest").to_pylist(), object),
                "point": rows.column("point").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDS),
            }
            return partners(group, num, den, most)

        def record(found):
            return pa.RecordBatch.from_arrays(
                [pa.array(found[0], pa.binary()), pa.array(found[1], pa.binary()), pa.array(found[2], pa.bool_())], ["a", "b", "more"]
            )

        last = None
        for batch in batches:
            name = list(zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j"))))
            start = 0
            for at in range(batch.num_rows):
                if name[at] != last:
                    if at > start:
                        held.append(batch.slice(start, at - start))
                    if held:
                        yield record(answer(held))
                    held, start, last = [], at, name[at]
            if batch.num_rows > start:
                held.append(batch.slice(start))
        if held:
            yield record(answer(held))

    return dealt.mapInArrow(run, "a binary, b binary, more boolean")


def repeated_ids(signed: DataFrame, needed: DataFrame) -> bool:
    """Whether an id of ``needed`` stands in several rows."""
    rows = join_lookup(signed.select("doc_id"), needed.select("doc_id").distinct(), "doc_id", "left_semi", 500_000)
    return rows.count() > needed.count() or not needed.groupBy("doc_id").count().where("count > 1").isEmpty()


def near_components(signed: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame | None:
    """(node, root) of the set digests that have a link, None if none has."""
    # most keys occur once: keys travel alone first, and with their set only if
    # the filter of the others may hold them
    twice = cut(keyed_sets(docs, k, num, den).groupBy("key").count().where("count > 1").select("key"))
    spark = docs.sparkSession
    release(spark)
    members = cut(keyed_sets(docs, k, num, den, bloom_filter(twice)).distinct())
    # blocks with the same members are searched once
    alike = members.groupBy("key").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("did")).alias("x"),
        F.bit_xor(F.xxhash64("did", F.lit(1))).alias("y"), F.min("did").alias("pivot"),
    ).where("c > 1")
    once = alike.groupBy("c", "x", "y", "pivot").agg(F.min("key").alias("key"))
    blocks = cut(members.join(once.select("key", "c", "pivot"), "key"))
    if blocks.isEmpty():
        return None
    needed = cut(
        signed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.min("did").alias("did"))
        .join(blocks.select("did").distinct(), "did", "left_semi").select("digest", "doc_id")
    )
    texts = join_lookup(docs.select("doc_id", "text"), needed.select("doc_id").distinct(), "doc_id", "left_semi", 500_000)
    unnamed = not needed.where("doc_id is null").isEmpty()
    if unnamed:  # sets that only rows without an id hold
        texts = texts.unionByName(docs.where("doc_id is null").select("doc_id", "text"))
    sets = set_rows(texts.select("text"), k)
    if unnamed or repeated_ids(signed, needed):  # else each needed id is one row, with its own set
        sets = sets.join(needed.select("digest"), "digest", "left_semi").dropDuplicates(["digest"])
    sets = stored(sets)
    release(spark)
    points = sets.select("digest", "n", "point", "bits")
    n = tasks_for(blocks.count())  # as many rows as the next table has, but for sets of the same did
    named = cut(blocks.join(sets.select("did", "digest"), "did").select("key", "c", "digest", (F.col("did") == F.col("pivot")).alias("pivot")).coalesce(n))
    star = named.where("not pivot").select("key", F.col("digest").alias("a")).join(
        named.where("pivot").select("key", F.col("digest").alias("b")), "key"
    ).select("a", "b").where("a <> b").coalesce(n).distinct().coalesce(n)
    links = cut(_verified(star, points, sets, num, den, n))
    release(spark)
    open_blocks = named.where("c > 2").select("key", "digest", "pivot")
    most, again = PARTNERS, None
    while True:
        found = None if links.isEmpty() else cut(components(links))
        if found is None:
            placed = open_blocks.withColumn("root", F.col("digest"))
        else:
            placed = open_blocks.join(found.withColumnRenamed("node", "digest"), "digest", "left").withColumn(
                "root", F.coalesce("root", "digest")
            ).coalesce(n)
        spread = (
            placed.groupBy("key")
            .agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.max(F.when(F.col("pivot"), F.col("root"))).alias("home"))
            .where("r0 <> r1")
            .select("key", "home")
            .coalesce(n)
        )
        open_blocks = cut(
            placed.join(spread, "key").select("key", "digest", "pivot", "root", (~F.col("root").eqNullSafe(F.col("home"))).alias("asks")).coalesce(n)
        )
        if open_blocks.isEmpty():
            return found
        if again is not None:  # whoever got all its partners is done
            asked = open_blocks.join(again, "digest", "left").withColumn("asks", F.col("asks") & F.col("again").isNotNull()).drop("again")
            open_blocks = cut(asked.join(asked.where("asks").select("key").distinct(), "key", "left_semi").coalesce(n))
            if open_blocks.isEmpty():
                return found
        pairs = cut(_search_round(open_blocks, points, num, den, most, n)).coalesce(n)
        release(spark)
        open_blocks = open_blocks.select("key", "digest", "pivot")
        again = cut(pairs.where("more").select(F.col("a").alias("digest"), F.lit(True).alias("again")).distinct().coalesce(n))
        new = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().coalesce(n)
        added = cut(_verified(new, points, sets, num, den, n))
        release(spark)
        left_out = not again.isEmpty()
        if not added.isEmpty():
            links = cut(added if found is None else added.union(found.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        if not left_out:
            return components(links) if not links.isEmpty() else None
        most *= 8


def jaccard_components(
    df: DataFrame, k: int = 3, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: texts are linked when
    den * |intersection| >= num * |union| of their sets of k-word shingles.

    Words are runs without ASCII white space, A-Z lower-cased.  Null and empty
    texts have no shingles, are linked with nothing and are their own
    component.  Repeated rows are linked like any equal texts.  A row without
    an id belongs to the component of equal sets that have one (the component
    id is null if none has).  Other columns are ignored.

    ``num / den`` must be 2/3 or more: linked sets must be no further apart in
    size than two neighbouring bands, or links would be missed.
    """
    if 3 * num < 2 * den or num > den:
        raise ValueError(f"similarity {num}/{den}: must be between 2/3 and 1")
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(signed_documents(docs, k))
    release(df.sparkSession)  # shuffles of what made the table
    classes = signed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    found = near_components(signed, docs, k, num, den)
    if found is None:
        placed = classes.select("digest", F.col("class_id").alias("component_id"))
    else:
        named = found.withColumnRenamed("node", "digest").join(classes, "digest")
        least = cut(named.groupBy("root").agg(F.min("class_id").alias("component_id")))
        linked = named.select("digest", "root").join(least, "root").select("digest", "component_id")
        placed = classes.join(linked, "digest", "left").select(
            "digest", F.coalesce("component_id", "class_id").alias("component_id")
        )
    return signed.select("doc_id", "n", "digest").join(placed, "digest", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """All columns of the document of each group of linked documents that
    gives the group its id, and of every unlinked document.  Rows without an
    id are named by their text, after all ids.

    Null and empty texts are linked with nothing and all stay.  Rows that
    repeat the id of the document that stays stay with it.  All columns are
    kept, whatever their names; an empty table stays empty.
    """
    if docs.where("doc_id is null").isEmpty():
        named, name = docs, F.col("doc_id")
    else:
        unnamed = F.col("doc_id").isNull()
        name = F.struct(
            unnamed.alias("unnamed"), F.col("doc_id").alias("id"),
            F.when(unnamed, F.md5(F.coalesce("text", F.lit("")))).otherwise("").alias("by"),
        )
        named = docs.select(name.alias("doc_id"), "text")
    gone = cut(jaccard_components(named, k, num, den).where("not component_id <=> doc_id").select("doc_id").distinct())
    return join_lookup(docs, gone.withColumnRenamed("doc_id", "gone_id"), name.eqNullSafe(F.col("gone_id")), "left_anti", 500_000)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
