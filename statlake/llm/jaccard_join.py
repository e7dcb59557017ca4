"""Near-duplicate join on word shingles by a size-aware heavy-light method.

Documents with equal shingle sets form one *class*.  Two classes link when
their Jaccard similarity is at least 3/4, that is 7 * overlap >= 3 * (n + m).
Shingles have one global order, rare before common, so linked sets must meet
in their first few shingles:

* *light* sets (few shingles) enumerate the 2-subsets of their first
  ``n - ceil(3n/4) + 2`` shingles; linked light sets share a subset;
* *heavy* sets post each of their first ``n - ceil(3n/4) + 1`` shingles and
  scan the inverted lists; light sets near the boundary are posted as well.

The boundary minimises the estimated cost over the histogram of sizes.

A list is scanned in two steps, so that no group is expanded into all pairs:
first every member is compared with the list's centre, the member with the
fewest rarer shingles; verified links give components.  Then only members of
*different* components are compared, in blocks of bounded size, behind exact
upper bounds of the overlap (places of the shared shingle, and parity
sketches: the number of differing bits never exceeds the number of differing
shingles).  Candidates are verified on the full sets.  The first step is split
by a salt where a shingle is very frequent; the second takes the whole list,
also members that were alone with their salt.  No list, bucket or number of
partners is capped, so the components are those of all links.

Shingles are 64-bit hashes of five words.  The order needs no exact counts to
be right, only to be the same everywhere: frequent shingles are found by
adding up local counts over all documents, the ``HEAVY_MAX`` most frequent are
broadcast (four megabytes at most) and come last; all others go by hash.

Defined cases: null text and texts without words have no shingles and link
with nothing; fewer than five words are one shingle; repeated rows share a
class; rows of one id with different texts are linked by their own texts; null
ids carry links and are reported with a null component unless a row of the
component has an id; an empty table gives none; other columns pass by.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.components import components
from statlake.llm.frames import id_text, materialise, ship
from statlake.llm.text import mix, shingles, slices, words_of

HEAVY_MAX = 262_144   # shingles that are ordered by frequency
HEAVY_LEAST = 8       # ... if they occur at least so often
LOCAL_LEAST = 2       # local counts from here on are added up
LOCAL_SHINGLES = 4_000_000   # shingles counted together in a task
PAIR_COST = 20        # cost of a candidate pair, in postings
BLOCK = 1024          # members of a list compared in one task at once
SALT_ROWS = 20_000    # expected members of a list from which its scan is split
SMALL_WORDS = 8       # 64-bit words of the small sketch


def least_overlap(n):
    """Smallest overlap of a set of n with any linked set."""
    return -(-3 * n // 4)


def sketch(values: np.ndarray, words: int | None = None) -> np.ndarray:
    """Parity of the shingles per bit; about four bits a shingle, in a power of two of words."""
    if words is None:
        words = 1 << max(3, math.ceil(math.log2(max(1, len(values)) / 16)))
    bit = (mix(values) % np.uint64(64 * words)).astype(np.int64)
    odd = (np.bincount(bit, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def fold(a: np.ndarray, words: int) -> np.ndarray:
    """A sketch as it would be in fewer words."""
    while len(a) > words:
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return a


def may_link(a: np.ndarray, b: np.ndarray, n: int, m: int) -> bool:
    """False only if the sketches prove that the sets differ in too many shingles."""
    words = min(len(a), len(b))
    return 7 * int(np.bitwise_count(fold(a, words) ^ fold(b, words)).sum()) <= n + m


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _documents(batch: pa.RecordBatch, size: int):
    """Sorted distinct shingles of every row."""
    w = words_of(batch.column("text"), lower=True)
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        yield shingles(w.hashes[a:b], size)


def _signature(values: np.ndarray) -> tuple[int, int]:
    """Two independent 63- and 64-bit hashes of a set."""
    one, two = mix(values + np.uint64(1)), mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    c = int(mix(np.array([(int(one.sum(dtype=np.uint64)) + len(values)) % 2**64], np.uint64))[0] >> np.uint64(1))
    return c, int(two.sum(dtype=np.uint64).view(np.int64))


SET_SCHEMA = "kind int, doc_id long, text_hash long, n long, class long, class2 long, sketch binary, shingle long, count long"


def _scan_sets(size: int):
    """Rows of kind 0: a document's set; of kind 1: a shingle and its local count."""
    names = [x.split()[0] for x in SET_SCHEMA.split(", ")]

    def rows(kind, length, **cols):
        kinds = {"kind": pa.int32(), "sketch": pa.binary()}
        full = {"kind": pa.array(np.full(length, kind, np.int32))} | cols
        return pa.RecordBatch.from_arrays([full.get(c, pa.nulls(length, kinds.get(c, pa.int64()))) for c in names], names)

    def run(batches):
        held, seen, total = [], set(), 0

        def counts():
            values, count = np.unique(np.concatenate(held), return_counts=True)
            often = count >= LOCAL_LEAST
            return rows(1, int(often.sum()), shingle=_signed(values[often]), count=pa.array(count[often].astype(np.int64)))

        for batch in batches:
            for part in slices(batch, "text"):
                n, c1, c2, sk = [], [], [], []
                for values in _documents(part, size):
                    a, b = _signature(values)
                    n.append(len(values)), c1.append(a), c2.append(b), sk.append(sketch(values).tobytes())
                    if (a, len(values)) not in seen:
                        seen.add((a, len(values)))
                        held.append(values)
                        total += len(values)
                yield rows(0, part.num_rows, doc_id=part.column("doc_id"), text_hash=part.column("text_hash"),
                           n=pa.array(n, pa.int64()),
                           sketch=pa.array(sk, pa.binary()), **{"class": pa.array(c1, pa.int64()),
                                                                "class2": pa.array(c2, pa.int64())})
                if total >= LOCAL_SHINGLES:
                    yield counts()
                    held, seen, total = [], set(), 0
        if held:
            yield counts()
    return run


def choose_boundary(sizes: dict[int, int], repeats: float) -> int:
    """Largest light size: the least estimated cost of subsets up to it and
    postings (each with its share of candidate pairs) beyond three quarters of it.
    ``repeats``: how many further sets a posting meets on average."""
    if not sizes:
        return 0
    n = np.array(sorted(sizes))
    count = np.array([sizes[int(x)] for x in n], float)
    spare = n - least_overlap(n)
    subset = np.cumsum(count * (spare + 2) * (spare + 1) / 2)
    posting = np.append(np.cumsum((count * (spare + 1) * (1 + PAIR_COST * repeats))[::-1])[::-1], 0)
    from_ = np.searchsorted(n, 3 * n / 4, side="right")   # the first size that is posted if x is the boundary
    cost = np.append(posting[0], subset + posting[from_])
    best = int(cost.argmin())
    return int(n[best - 1]) if best else 0


def _postings(size: int, boundary: int, shared):
    """Keys of the classes of a task, each class once: key, salt (-1: the key is not split), class, n, place."""
    def run(batches):
        heavy, count = shared.value
        order = np.empty(len(heavy), np.int64)
        order[np.lexsort((heavy, count))] = np.arange(len(heavy))
        seen = set()
        for batch in batches:
            for part in slices(batch, "text"):
                keys, salts, classes, ns, places = [], [], [], [], []

                def add(key, split, c, n, place):
                    keys.append(key), salts.append(np.where(split > 1, c % split, -1)), places.append(place)
                    classes.append(np.full(len(key), c, np.int64)), ns.append(np.full(len(key), n, np.int64))

                for values in _documents(part, size):
                    n = len(values)
                    c = _signature(values)[0]
                    if n < 3 or (c, n) in seen:   # one and two shingles link with equal sets only
                        continue
                    seen.add((c, n))
                    at = np.searchsorted(heavy, values)
                    at[at == len(heavy)] = 0
                    common = heavy[at] == values if len(heavy) else np.zeros(n, bool)
                    rare = values[~common]
                    late = at[common][np.argsort(order[at[common]])]
                    spare = n - least_overlap(n)
                    first = np.concatenate([rare[:spare + 2], heavy[late][:max(0, spare + 2 - len(rare))]])
                    times = np.concatenate([np.zeros(min(len(rare), spare + 2), np.int64),
                                            count[late][:max(0, spare + 2 - len(rare))]])
                    split = 1 + times // SALT_ROWS
                    if n <= boundary:
                        i, j = np.triu_indices(len(first), 1)
                        add(mix(mix(first[i]) + first[j]), np.minimum(split[i], split[j]), c, n, i)
                    if 4 * n > 3 * boundary:
                        add(first[:spare + 1], split[:spare + 1], c, n, np.arange(spare + 1))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [_signed(np.concatenate(keys)), pa.array(np.concatenate(salts).astype(np.int32)),
                         *[pa.array(np.concatenate(x).astype(t)) for x, t in
                           ((classes, np.int64), (ns, np.int32), (places, np.int32))]],
                        ["key", "salt", "class", "n", "place"])
    return run


def _sketched(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes (a, b) that the full sketches leave."""
    side = lambda s: classes.select(F.col("class").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "sketch")])

    def run(batches):
        for b in batches:
            a, c = b.column("sketch_a").to_pylist(), b.column("sketch_b").to_pylist()
            n, m = b.column("n_a").to_pylist(), b.column("n_b").to_pylist()
            keep = [may_link(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), i, j)
                    for x, y, i, j in zip(a, c, n, m)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long"))


def _verified(pairs: DataFrame, classes: DataFrame, base: DataFrame, size: int) -> DataFrame:
    """The pairs of classes whose full sets link."""
    pairs = materialise(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    # one document of every class; null ids cannot be looked up and are all read
    names = (classes.select("class", F.col("rep").alias("doc_id")).join(wanted, "class", "left_semi")
             .select("doc_id").where("doc_id IS NOT NULL").distinct())

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [v for v in _documents(part, size) if len(v)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_signature(v)[0] for v in sets], pa.int64()),
                     pa.array([v.view(np.int64) for v in sets], pa.list_(pa.int64()))], ["class", "set"])

    # a repeated id may come with different texts: sets go by their class
    read = base.join(names, "doc_id", "left_semi").union(base.where("doc_id IS NULL"))
    sets = materialise(read.mapInArrow(run, "class long, set array<long>").join(wanted, "class", "left_semi")
                       .groupBy("class").agg(F.first("set").alias("set")), "sets")
    x = pairs.join(sets.select(F.col("class").alias("a"), F.col("set").alias("set_a")), "a")
    y = x.join(sets.select(F.col("class").alias("b"), F.col("set").alias("set_b")), "b")
    overlap = F.size(F.array_intersect("set_a", "set_b"))
    return y.where(7 * overlap >= 3 * (F.size("set_a") + F.size("set_b"))).select("a", "b").distinct()


def _cross_pairs(batches):
    """Pairs of different components within (key, first, second) runs of sorted rows."""
    names, held, last = ["class", "n", "place", "component", "block"], [], None

    def emit(rows: list[pa.RecordBatch], first: int, second: int):
        t = pa.Table.from_batches(rows)
        c, n, place, comp, block = (t.column(x).to_numpy() for x in names)
        small = np.stack([t.column(f"s{k}").to_numpy().view(np.uint64) for k in range(SMALL_WORDS)])
        left = np.flatnonzero(block == first)
        right = np.flatnonzero(block == second)
        for at in range(0, len(left), 256):
            i = left[at:at + 256][:, None]
            j = right[None, :]
            ok = (comp[i] != comp[j]) & (7 * np.minimum(n[i] - place[i], n[j] - place[j]) >= 3 * (n[i] + n[j]))
            if first == second:
                ok &= i < j
            x, y = np.nonzero(ok)
            if not len(x):
                continue
            x, y = i[x, 0], j[0, y]
            bits = np.bitwise_count(small[:, x] ^ small[:, y]).sum(0, dtype=np.int64)
            ok = 7 * bits <= n[x] + n[y]
            x, y = x[ok], y[ok]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(c[x], c[y])), pa.array(np.maximum(c[x], c[y]))], ["a", "b"])

    for b in batches:
        if not b.num_rows:
            continue
        key = np.stack([b.column(x).to_numpy() for x in ("key", "first", "second")], 1)
        cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
            this = tuple(key[lo].tolist())
            if this != last and held:
                yield from emit(held, *last[1:])
                held = []
            last = this
            held.append(b.slice(lo, hi - lo))
    if held:
        yield from emit(held, *last[1:])


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, and text_hash (xxhash64 of the
    text), which tells rows of one id apart."""
    spark = docs.sparkSession
    ship(spark)
    base = id_text(docs, id_col, text_col)
    scan = materialise(base.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_scan_sets(size), SET_SCHEMA), "shingle-sets")
    sets = scan.where("kind = 0").select("doc_id", "text_hash", "n", "class", "class2", "sketch")
    # equal signatures and sizes: one class, known by the first signature and its smallest id
    classes = materialise(sets.where("n > 0").groupBy("class", "class2", "n").agg(
        F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")), "classes")

    # the most frequent shingles, cut between classes of counts so that no more than
    # HEAVY_MAX are fetched; only the sizes of these classes are looked at first
    grade = F.floor(F.log2("count") * 8).cast("int")
    counted = materialise(scan.where("kind = 1").groupBy("shingle").agg(F.sum("count").alias("count"))
                          .where(F.col("count") >= HEAVY_LEAST).withColumn("grade", grade), "frequent-shingles")
    cut, taken = 1 << 30, 0
    for r in sorted(counted.groupBy("grade").count().collect(), key=lambda r: -r["grade"]):
        taken += r["count"]
        if taken > HEAVY_MAX:
            break
        cut = r["grade"]
    heavy = counted.where(F.col("grade") >= cut).select("shingle", "count").toArrow()
    values = heavy.column("shingle").to_numpy().view(np.uint64)
    count = heavy.column("count").to_numpy()
    by_value = np.argsort(values)
    shared = spark.sparkContext.broadcast((values[by_value], count[by_value]))
    sizes = {r.n: r["count"] for r in classes.groupBy("n").count().collect()}   # bounded by the longest text's words
    repeated = scan.where("kind = 1").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("x")).first().x
    boundary = choose_boundary(sizes, repeated / max(1, sum(n * k for n, k in sizes.items())))

    postings = base.mapInArrow(_postings(size, boundary, shared), "key long, salt int, class long, n int, place int")
    by_list = Window.partitionBy("key", "salt").orderBy("place", "class")
    ranked = postings.select("*", F.first(F.struct("class", "n", "place")).over(by_list).alias("centre"))
    # the centre of a part of a split list stays: it has not met the other parts
    members = materialise(ranked.where("class != centre.class OR salt >= 0"), "list-members")
    fits = F.expr("7 * least(n - place, centre.n - centre.place) >= 3 * (n + centre.n)")
    stars = members.where("class != centre.class").where(fits).select(F.least("class", "centre.class").alias("a"),
                                       F.greatest("class", "centre.class").alias("b")).distinct()
    links = materialise(_verified(_sketched(stars, classes), classes, base, size), "links")
    roots = components(links)

    # lists whose members are not yet together; a list of two that was not split has been compared
    split = (F.col("salt") >= 0).alias("split")
    everyone = members.select("key", split, "class", "n", "place").union(
        members.select("key", split, "centre.class", "centre.n", "centre.place")).distinct()
    small = [F.col("small")[k].alias(f"s{k}") for k in range(SMALL_WORDS)]
    known = classes.join(roots, F.col("class") == F.col("node"), "left").select(
        "class", F.coalesce("root", "class").alias("component"))
    placed = everyone.join(known, "class")
    # lists of the same members are the same comparisons: the one whose shingle comes
    # first stays, and no pair's first common shingle is lost, as it would be earlier still
    open_ = (placed.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("component").alias("x"), F.max("component").alias("y"),
        F.sum(F.xxhash64("class").cast("decimal(20,0)")).alias("one"),
        F.sum(F.xxhash64("class", F.lit(7)).cast("decimal(20,0)")).alias("two"),
        F.min(F.struct("class", "place"))["place"].alias("place"), F.max("split").alias("split"))
        .where("(members > 2 OR split) AND x != y")
        .groupBy("members", "one", "two").agg(F.min(F.struct("place", "key"))["key"].alias("key"))
        .select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")))
    rows = materialise(placed.join(open_, "key"), "open-lists")
    folded = classes.join(rows.select("class").distinct(), "class", "left_semi").select("class", "sketch").mapInArrow(
        _fold_small, "class long, small array<long>")
    rows = rows.join(folded, "class").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    rows = rows.select("key", "class", "n", "place", "component", "block", *small, F.explode(F.sequence(
        F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("*", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    crossing = (rows.drop("other").repartition("key", "first", "second").sortWithinPartitions("key", "first", "second")
                .mapInArrow(_cross_pairs, "a long, b long").distinct())
    more = _verified(_sketched(crossing, classes), classes, base, size)
    final = components(links.union(materialise(more, "more-links")))

    rooted = classes.join(final, F.col("class") == F.col("node"), "left").select(
        "class", "class2", "n", "rep", F.coalesce("root", "class").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("rep").alias("component")), "root").drop("rep", "root")
    return (sets.drop("sketch").join(named, ["class", "class2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), "text_hash"))


def _fold_small(batches):
    for b in batches:
        folded = [fold(np.frombuffer(x, np.uint64), SMALL_WORDS).view(np.int64) for x in b.column("sketch").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("class"), pa.array(folded, pa.list_(pa.int64()))], ["class", "small"])
