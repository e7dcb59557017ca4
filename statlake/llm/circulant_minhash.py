"""Near-duplicate detection by circulant MinHash.

*Signatures.*  Shingles are numbered by their 64-bit hash.  A first permutation
places a number on a circle, a second one gives the value of every place, and
coordinate k of a signature is the least value over the set after turning the
circle by k places: two permutations generate all coordinates.  As the turned
values of one place lie next to each other, a set's signature is the minimum
over contiguous runs of the second permutation.  The circle has 2**20 places;
sets that would fill it (over 131 072 shingles) use a circle of 2**64 places
whose permutations are bit mixers, and sets near that size use both, so that no
pair is separated by the change.

*Banding.*  ``BANDS`` bands of ``ROWS`` coordinates; sets that agree in a band
share its bucket.  A pair at the threshold of 0.85 misses all 40 bands of 6 with
probability 6e-9, one at 0.9 with 4e-14.

*Verification.*  Documents with equal sets are one class.  In a bucket every
class is first compared with the bucket's centre, its least class; verified
links give components.  Where classes of a bucket are then in different components, they
are compared with a second centre, drawn anew in every bucket.  Buckets that are
still not together are compared throughout, in blocks of bounded size; only pairs
of different components leave the task, and each from one bucket only.  Before sets are fetched, parity sketches bound the
symmetric difference from below (differing bits never exceed differing
shingles), so no link is lost there.  Every link is confirmed on full sets.
Nothing is capped, and copies never meet each other: one class is one row.

Sets differing in one shingle link only from 6 shingles on, so smaller sets
link with equal sets alone and enter no bucket.

Defined cases: null text and texts without words have no shingles and link with
nothing; fewer words than a shingle has are one shingle; repeated rows and rows
of one id with different texts are documents of their own that share the id;
null ids link like others, but name no component: a component of null ids alone
has a null id, and its rows are kept; empty tables give none; other columns are
ignored; whole texts are read, whatever their length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.components import components
from statlake.llm.frames import id_text, materialise, ship
from statlake.llm.held import held
from statlake.llm.text import mix, shingles, slices, words_of

BANDS, ROWS = 40, 6
CIRCLE_BITS = 20
#: Sets above go to the larger circle; sets within the threshold's ratio of it to both.
CIRCLE_MOST = 1 << 17
LEAST_SIZE = 6        # sets below link with equal sets only
BLOCK = 1024          # classes of a bucket compared in one task at once
SKETCH_WORDS = 64     # 64-bit words of the sketches compared inside buckets
SEED = 20260131


class Circle:
    """The two permutations; ``places`` coordinates by turning the second one."""

    def __init__(self, places: int, bits: int = CIRCLE_BITS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.places, self.mask = places, np.uint64((1 << bits) - 1)
        self.first = rng.permutation(1 << bits)
        self.second = rng.permutation(1 << bits).astype(np.uint32)
        self.turns = sliding_window_view(np.concatenate([self.second, self.second[:places - 1]]), places)

    def signature(self, values: np.ndarray) -> np.ndarray:
        at = self.first[(values & self.mask).astype(np.int64)]
        out = np.full(self.places, np.iinfo(np.uint32).max, np.uint32)
        for lo in range(0, len(at), 1024):
            np.minimum(out, self.turns[at[lo:lo + 1024]].min(0), out=out)
        return out.astype(np.uint64)


def wide_signature(values: np.ndarray, places: int, seed: int = SEED) -> np.ndarray:
    """The same on a circle of 2**64 places."""
    at = mix(values ^ np.uint64(seed))
    return np.array([mix(at + np.uint64(k)).min() for k in range(places)], np.uint64)


def band_keys(values: np.ndarray) -> list[int]:
    """A key per band (and circle) of a set."""
    if len(values) < LEAST_SIZE:
        return []
    places = BANDS * ROWS
    found = []
    if 85 * len(values) <= 100 * CIRCLE_MOST:
        found.append((0, held(("circle", places), lambda: Circle(places)).signature(values)))
    if 100 * len(values) >= 85 * CIRCLE_MOST:
        found.append((1, wide_signature(values, places)))
    keys = []
    for circle, signature in found:
        key = np.arange(BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(circle + 1)
        for row in signature.reshape(BANDS, ROWS).T:
            key = mix(key ^ mix(row + np.uint64(1)))
        keys += key.view(np.int64).tolist()
    return keys


def set_digest(values: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set; with its size they name its class."""
    return tuple(int(mix(np.array([np.bitwise_xor.reduce(mix(values + np.uint64(salt))) + np.uint64(len(values))],
                                  np.uint64)).view(np.int64)[0]) for salt in (1, 0x5851F42D))


def parity(values: np.ndarray) -> np.ndarray:
    """Which bits an odd number of shingles falls on; a power of two of words,
    at least four bits a shingle, so that larger sketches fold to smaller ones."""
    words = 8
    while 64 * words < 4 * len(values):
        words *= 2
    odd = np.bincount((mix(values + np.uint64(3)) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(a: np.ndarray, words: int) -> np.ndarray:
    while len(a) > words:
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return a


def links(overlap, n, m):
    """Whether sets of n and m shingles with that overlap link."""
    return 100 * overlap >= 85 * (n + m - overlap)


def may_differ(bits, n, m):
    """Whether a linked pair may differ in so many bits: at 0.85 the symmetric
    difference is at most 3/37 of the sum of the sizes."""
    return 37 * bits <= 3 * (n + m)


def _sets(part: pa.RecordBatch, size: int):
    w = words_of(part.column("text"), lower=True)
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        yield shingles(w.hashes[a:b], size)


def _scan(size: int):
    """Per document its class; sketch and band keys once per class and task."""
    def run(batches):
        seen = set()
        for batch in batches:
            for part in slices(batch, "text"):
                out = {"n": [], "c1": [], "c2": [], "sketch": [], "keys": []}
                for values in _sets(part, size):
                    c1, c2 = set_digest(values) if len(values) else (0, 0)
                    new = len(values) > 0 and (c1, c2) not in seen
                    if new:
                        seen.add((c1, c2))
                    for k, v in zip(out, (len(values), c1, c2, parity(values).tobytes() if new else None,
                                          band_keys(values) if new else None)):
                        out[k].append(v)
                kinds = {"sketch": pa.binary(), "keys": pa.list_(pa.int64())}
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(v, kinds.get(k, pa.int64()))
                                                                          for k, v in out.items()]], ["doc_id", *out])
    return run


def _passing(batches):
    """Pairs whose full sketches leave the link open."""
    for b in batches:
        keep = []
        for x, y, n, m in zip(*[b.column(c).to_pylist() for c in ("sketch_a", "sketch_b", "n_a", "n_b")]):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            words = min(len(x), len(y))
            keep.append(bool(may_differ(int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()), n, m)))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _side(classes: DataFrame, name: str, *columns: str) -> DataFrame:
    return classes.select(F.col("class").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])


def _similar_sizes(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= 85 * F.greatest(n, m)


def confirmed(pairs: DataFrame, classes: DataFrame, base: DataFrame, size: int) -> DataFrame:
    """The pairs of classes (a, b) whose full sets link."""
    pairs = materialise(pairs.join(_side(classes, "a", "n", "sketch"), "a").join(_side(classes, "b", "n", "sketch"), "b")
                        .mapInArrow(_passing, "a long, b long"), "minhash-pairs")
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    wanted = materialise(classes.select("class", "c1", "c2", "n", "rep").join(wanted, "class", "left_semi"), "minhash-wanted")
    # one document of every class that is compared; null ids cannot be looked up and are all read
    names = wanted.select(F.col("rep").alias("doc_id")).where("doc_id IS NOT NULL").distinct()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [v for v in _sets(part, size) if len(v)]
                c1, c2 = zip(*[set_digest(v) for v in sets]) if sets else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array([len(v) for v in sets], pa.int64()),
                     pa.array([v.view(np.int64) for v in sets], pa.list_(pa.int64()))], ["c1", "c2", "n", "items"])

    read = base.join(names, "doc_id", "left_semi").union(base.where("doc_id IS NULL"))
    items = materialise(read.mapInArrow(run, "c1 long, c2 long, n long, items array<long>")
                        .join(wanted.drop("rep"), ["c1", "c2", "n"])
                        .groupBy("class").agg(F.first("items").alias("items")), "minhash-sets")
    both = pairs.join(_side(items, "a", "items"), "a").join(_side(items, "b", "items"), "b")
    overlap = F.size(F.array_intersect("items_a", "items_b"))
    return both.where(links(overlap, F.size("items_a"), F.size("items_b"))).select("a", "b").distinct()


def _cross(batches):
    """Pairs of different components between two blocks of a bucket; rows come
    sorted by (key, first, second), the blocks' classes are held for one such run."""
    names = ["class", "n", "component", "block", "sketch", "buckets"]
    held, last = [], None

    def widths(sketches):
        """(words of each sketch, {words: all sketches of at least so many, folded})."""
        arrays = [np.frombuffer(x, np.uint64) for x in sketches]
        words = np.array([len(a) for a in arrays])
        return words, {w: np.stack([folded(a, w) if len(a) >= w else np.zeros(w, np.uint64) for a in arrays])
                       for w in np.unique(words).tolist()}

    def pairs(rows, key, first, second):
        t = pa.Table.from_batches(rows)
        c, n, comp, block = (t.column(x).to_numpy() for x in names[:4])
        words, bits = widths(t.column("sketch").to_pylist())
        buckets = t.column("buckets").to_pylist()
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        for lo in range(0, len(left), 128):
            i, j = left[lo:lo + 128][:, None], right[None, :]
            ok = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= 85 * np.maximum(n[i], n[j]))
            if first == second:
                ok &= i < j
            x, y = np.nonzero(ok)
            x, y = left[lo + x], right[y]
            keep, width = np.zeros(len(x), bool), np.minimum(words[x], words[y])
            for w, sketch in bits.items():
                some = np.flatnonzero(width == w)
                for s in range(0, len(some), 8192):
                    q = some[s:s + 8192]
                    differ = np.bitwise_count(sketch[x[q]] ^ sketch[y[q]]).sum(1, dtype=np.int64)
                    keep[q] = may_differ(differ, n[x[q]], n[y[q]])
            keep[keep] = [min(set(buckets[i]).intersection(buckets[j])) == key for i, j in zip(x[keep], y[keep])]
            x, y = x[keep], y[keep]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(c[x], c[y])), pa.array(np.maximum(c[x], c[y]))], ["a", "b"])

    for b in batches:
        if not b.num_rows:
            continue
        at = np.stack([b.column(x).to_numpy() for x in ("key", "first", "second")], 1)
        cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            this = tuple(at[lo].tolist())
            if this != last and held:
                yield from pairs(held, *last)
                held = []
            last = this
            held.append(b.slice(lo, hi - lo).select(names))
    if held:
        yield from pairs(held, *last)


def _small_sketches(batches):
    for b in batches:
        small = [folded(np.frombuffer(x, np.uint64), SKETCH_WORDS).tobytes() for x in b.column("sketch").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("class"), pa.array(small, pa.binary()), b.column("buckets")],
                                         ["class", "sketch", "buckets"])


def _placed(members: DataFrame, linked: DataFrame) -> DataFrame:
    """With the component of every class, by the links known so far."""
    return (members.join(components(linked).withColumnRenamed("node", "class"), "class", "left")
            .withColumn("component", F.coalesce("root", "class")).drop("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    ship(docs.sparkSession)
    base = id_text(docs, id_col, text_col)
    scan = materialise(base.mapInArrow(_scan(size), "doc_id long, n long, c1 long, c2 long, sketch binary, keys array<long>"),
                       "minhash-scan")
    # numbered as they are written
    classes = materialise(scan.where("n > 0").groupBy("c1", "c2", "n").agg(
        F.min("doc_id").alias("rep"), F.first("sketch", True).alias("sketch"), F.first("keys", True).alias("keys"))
        .withColumn("class", F.monotonically_increasing_id()), "minhash-classes")

    postings = classes.select("class", "n", F.explode("keys").alias("key"))
    buckets = postings.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("class", "n")).alias("centre"))
    members = materialise(postings.join(buckets.where("members > 1"), "key"), "minhash-buckets")
    stars = (members.where(F.col("class") != F.col("centre.class")).where(_similar_sizes(F.col("n"), F.col("centre.n")))
             .select(F.col("centre.class").alias("a"), F.col("class").alias("b")).distinct())
    first = materialise(confirmed(stars, classes, base, size), "minhash-links")

    # a second centre, drawn anew in every bucket, for buckets of three and more
    # whose classes are not together yet: a class meets up to one per band
    large = members.where("members > 2").select("key", "class", "n", "members")
    drawn = F.min(F.struct(F.xxhash64("class", "key").alias("draw"), "class", "n", "component"))
    again, spread = _placed(large, first), [F.min("component").alias("x"), F.max("component").alias("y")]
    centres = again.groupBy("key").agg(*spread, drawn.alias("centre")).where("x != y")
    more_stars = (again.join(centres, "key").where(F.col("component") != F.col("centre.component"))
                  .where(_similar_sizes(F.col("n"), F.col("centre.n")))
                  .select(F.least("class", "centre.class").alias("a"), F.greatest("class", "centre.class").alias("b")).distinct())
    second = materialise(first.union(confirmed(more_stars, classes, base, size)), "minhash-links")

    # what is still apart is compared throughout; buckets of the same classes are
    # the same comparisons: one of them stays
    placed = _placed(large, second)
    mark = [F.sum(F.xxhash64("class", F.lit(k)).cast("decimal(20,0)")).alias(f"mark{k}") for k in (0, 1)]
    open_ = (placed.groupBy("key").agg(F.first("members").alias("members"), *spread, *mark).where("x != y")
             .groupBy("members", "mark0", "mark1").agg(F.min("key").alias("key"))
             .select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")))
    rows = materialise(placed.drop("members").join(open_, "key"), "minhash-open")
    # with the buckets of each class, so that a pair leaves the first one it shares only
    own = rows.groupBy("class").agg(F.sort_array(F.collect_set("key")).alias("buckets"))
    sketches = (classes.join(own, "class").select("class", "sketch", "buckets")
                .mapInArrow(_small_sketches, "class long, sketch binary, buckets array<long>"))
    rows = (rows.join(sketches, "class").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other")))
    crossing = (rows.select("key", "first", "second", "class", "n", "component", "block", "sketch", "buckets")
                .repartition("key", "first", "second").sortWithinPartitions("key", "first", "second")
                .mapInArrow(_cross, "a long, b long"))
    more = materialise(confirmed(crossing, classes, base, size), "minhash-more-links")

    final = components(second.union(more))
    rooted = classes.join(final.withColumnRenamed("node", "class"), "class", "left").select(
        "c1", "c2", "n", "rep", F.coalesce("root", "class").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("rep").alias("component")), "root").drop("rep", "root")
    out = scan.select("doc_id", "n", "c1", "c2").join(named, ["c1", "c2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))
