"""Near duplicates by b-bit MinHash.

1. Each document becomes a set of hashed word shingles, 96 minima of it, 32 band keys of three
   minima each, and a signature of the low four bits of every minimum, packed into six longs. Two
   sets of similarity 0.75 share no band with probability (1 - 0.75^3)^32 < 3e-8.
2. Documents with equal sets are one class; only its document with the smallest id goes on, so a
   group of copies of any size costs one row.
3. Candidates share a band. Each bucket compares its members with one of them, its hub, which is
   picked by a hash and differs from bucket to bucket: one pair a row, not all pairs of the bucket.
   Signatures give an estimate of the similarity, corrected for chance agreement of four bits, by
   counting bits; pairs six standard errors under the threshold or too unlike in size go, the rest are
   confirmed on full sets.
4. Links are contracted to components (alternating large and small stars). Buckets that then still
   hold several components besides the hub compare all members outside the largest component with
   all members, in blocks of bounded size inside a task, by signatures of 2048 minima that only these
   documents get. Sizes of the sets (exactly) and the short signatures go first, so few pairs come to the
   long ones. No pair leaves the task: documents with a partner less than five standard errors under the
   threshold do, one row each, and meet once more with their full sets, where links are confirmed and
   only those go out that join components not joined in that task yet, fewer than it has documents.
   After this every pair that shares a band has been compared or is connected already. Rows grow with the
   documents; the comparisons in a bucket are still quadratic in those that share it without being alike
   or connected.

Results: null and empty texts, and texts without words, have an empty set and are linked with
nothing; rows sharing a doc_id count as one document with several texts; a row without doc_id is
linked with nothing, its component_id is null and it is kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.llm.base import texts_of
from rollmill.llm.words import mix, odd_numbers, shingle_set, word_hashes, words_of
from rollmill.session import scratch_path, stage

BITS = 4
PER_LONG = 64 // BITS
# Rows of a bucket compared with each other in one task.
BLOCK = 4096
ONES = 0x1111111111111111
# Shingles of either side of a comparison of full sets in one task, plus at most one document's.
SHINGLES = 2_000_000
# Minima of the signatures that tell apart what shares a bucket and is not connected.
LONG = 2048


@dataclass(frozen=True)
class MinHash:
    width: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 3

    @property
    def size(self) -> int:
        return self.bands * self.rows


def misses_allowed(percent: int, size: int, errors: float) -> int:
    """Differing minima of a pair that may still reach the threshold, so many standard errors off."""
    agree = percent / 100 + (1 - percent / 100) / 2**BITS
    return min(size, int(size * (1 - agree) + errors * (size * agree * (1 - agree)) ** 0.5))


def estimate(agreeing: Column | float, size: int) -> Column | float:
    """Similarity from the number of agreeing minima, without those that agree by chance."""
    chance = 2.0**-BITS
    return (agreeing / size - chance) / (1 - chance)


def minima_of(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        hashed = shingles[at : at + 512, None] * factors
        hashed += offsets
        np.minimum(out, hashed.min(axis=0), out=out)
    return out


def digests(docs: DataFrame, how: MinHash = MinHash()) -> DataFrame:
    """doc_id, set size, 128-bit key of the set, packed signature and band keys of every row."""
    schema = "doc_id long, n_shingles long, set_a long, set_b long, sig array<long>, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, offsets = odd_numbers(how.size, seed=1), odd_numbers(how.size, seed=2)
        in_band, band_no = odd_numbers(how.rows, seed=3), odd_numbers(how.bands, seed=4)
        places = np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)
        for batch in batches:
            sizes, keys_a, keys_b, sigs, bands = [], [], [], [], []
            for text in texts_of(batch):
                s = shingle_set(word_hashes(words_of(text)), how.width)
                sizes.append(len(s))
                keys_a.append(mix(s).sum(dtype=np.uint64))
                keys_b.append(mix(s ^ factors[0]).sum(dtype=np.uint64))
                if len(s) == 0:
                    sigs.append(None)
                    bands.append(None)
                    continue
                least = mix(minima_of(s, factors, offsets))
                low = (least & np.uint64(2**BITS - 1)).reshape(-1, PER_LONG)
                sigs.append((low << places).sum(axis=1, dtype=np.uint64).view(np.int64))
                keyed = (least.reshape(how.bands, how.rows) * in_band).sum(axis=1, dtype=np.uint64)
                bands.append(mix(keyed + band_no).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(keys_a, dtype=np.uint64).view(np.int64)),
                    pa.array(np.array(keys_b, dtype=np.uint64).view(np.int64)),
                    pa.array(sigs, pa.list_(pa.int64())),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sig", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def sets_of(docs: DataFrame, how: MinHash) -> DataFrame:
    """node and the full set, as sorted 64-bit numbers in one binary value. Rows that repeat a set
    of the row before with the same doc_id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, set()
        for batch in batches:
            nodes, found = [], []
            for node, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                if node != last:
                    last, seen = node, set()
                own = shingle_set(word_hashes(words_of(text)), how.width)
                key = int(mix(own).sum(dtype=np.uint64))
                if len(own) and key not in seen:
                    seen.add(key)
                    nodes.append(node)
                    found.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], names=["node", "shingles"]
            )

    return docs.mapInArrow(run, "node long, shingles binary")


def misses(a: str, b: str, longs: int) -> Column:
    """Minima whose low bits differ, by the bits set in the exclusive or of two packed signatures."""
    total = F.lit(0)
    for k in range(longs):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        for step in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        total = total + F.bit_count(x.bitwiseAND(F.lit(ONES)))
    return total


def confirm(pairs: DataFrame, sets: DataFrame, how: MinHash) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hold = []
            for x, y in zip(batch.column("set_x"), batch.column("set_y")):
                u, v = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                if len(u) > len(v):
                    u, v = v, u
                at = np.searchsorted(v, u)
                at[at == len(v)] = 0
                both = int((v[at] == u).sum())
                hold.append(100 * both >= how.percent * (len(u) + len(v) - both))
            yield batch.select(["a", "b"]).filter(pa.array(hold, pa.bool_()))

    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_x"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "set_x", "set_y").mapInArrow(run, "a long, b long")


def are_stars(edges: DataFrame) -> bool:
    """Whether every node either has one smaller neighbour or is the smallest of its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return ends.where("up > 1 OR (up = 1 AND down > 0)").isEmpty()


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(node, root) for every node of (a, b) edges but the roots; the root is the smallest node.

    Large stars tie all larger neighbours of a node to its smallest, small stars all smaller ones;
    both keep components and their number of rounds grows with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    while not are_stars(now):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        big = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = big.groupBy("a").agg(F.min("b").alias("m"))
        tied = big.join(least, "a")
        ends = F.explode(F.array("a", "b")).alias("a")
        now = tied.select(ends, F.col("m").alias("b")).where("a <> b").distinct()
        now = stage(now, scratch_path(spark, name))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")


def differing(many: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Minima whose low bits differ from those of ``own``, for each row of packed signatures."""
    x = many ^ own
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return np.bitwise_count(x & np.uint64(ONES)).sum(axis=1, dtype=np.int64)


def long_signatures(sets: DataFrame, how: MinHash) -> DataFrame:
    """node and the low bits of LONG minima, packed, of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, offsets = odd_numbers(LONG, seed=5), odd_numbers(LONG, seed=6)
        places = np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)
        for batch in batches:
            out = []
            for own in batch.column("shingles"):
                s = np.frombuffer(own.as_buffer(), dtype=np.uint64)
                low = (mix(minima_of(s, factors, offsets)) & np.uint64(2**BITS - 1)).reshape(-1, PER_LONG)
                out.append((low << places).sum(axis=1, dtype=np.uint64).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary())], names=["node", "long"])

    return sets.mapInArrow(run, "node long, long binary")


MEETS = ("bucket", "i", "j", "k", "l")
MEETING = "bucket long, i int, j int, k int, l int, minor boolean, node long, comp long"


def meeting(bucket: int, i: int, j: int, minor: dict, others: dict, room: int) -> pa.RecordBatch:
    """Rows that bring the documents of a block together again (node to component and set size), in
    parts ``k`` of the one side and ``l`` of the other that hold ``room`` shingles and one document's."""
    sides = []
    for side in (minor, others):
        ends = np.cumsum([z for _, z in side.values()]) // room
        sides.append(np.unique(ends, return_inverse=True)[1].tolist())
    parts = [max(s) + 1 for s in sides]
    rows = [(p, q, True, n, c) for (n, (c, _)), p in zip(minor.items(), sides[0]) for q in range(parts[1])]
    rows += [(p, q, False, n, c) for (n, (c, _)), q in zip(others.items(), sides[1]) for p in range(parts[0])]
    k, l, of, node, comp = zip(*rows)
    place = [pa.array([bucket] * len(rows), pa.int64()), *(pa.array([x] * len(rows), pa.int32()) for x in (i, j))]
    place += [pa.array(k, pa.int32()), pa.array(l, pa.int32()), pa.array(of, pa.bool_())]
    return pa.RecordBatch.from_arrays(
        [*place, pa.array(node, pa.int64()), pa.array(comp, pa.int64())], names=[*MEETS, "minor", "node", "comp"]
    )


def linked(rows: list[tuple[bool, int, int, bytes]], how: MinHash) -> pa.RecordBatch:
    """Links between components that the full sets of (minor, node, component, set) confirm, minor
    documents against the others; links that join what others join already are left out."""
    minor, every = [r for r in rows if r[0]], [r for r in rows if not r[0]]
    a, b, up = [], [], {}

    def top(c: int) -> int:
        while c in up:
            c = up[c]
        return c

    if minor and every:
        sizes = np.array([len(r[3]) // 8 for r in every])
        comp = np.array([r[2] for r in every])
        starts = np.cumsum(sizes) - sizes
        known, at = np.unique(np.frombuffer(b"".join(r[3] for r in every), dtype=np.uint64), return_inverse=True)
        for _, node, own_comp, own in minor:
            own = np.frombuffer(own, dtype=np.uint64)
            marked = np.zeros(len(known), dtype=np.int32)
            place = np.searchsorted(known, own)
            place[place == len(known)] = 0
            marked[place[known[place] == own]] = 1
            both = np.add.reduceat(marked[at], starts)
            hold = (100 * both >= how.percent * (len(own) + sizes - both)) & (comp != own_comp)
            for x in np.flatnonzero(hold).tolist():
                one, other = top(own_comp), top(every[x][2])
                if one != other:
                    up[max(one, other)] = min(one, other)
                    a.append(max(node, every[x][1]))
                    b.append(min(node, every[x][1]))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def candidates(members: DataFrame, hubs: DataFrame, sets: DataFrame, reps: DataFrame, how: MinHash) -> DataFrame:
    """Documents, other than the hub, with a partner of another component in their bucket by the estimate
    from long signatures: once for each block and part of a bucket in which they and partners meet. A
    pair counts in the first band that it shares: there it is either compared or was compared as hub
    and member."""
    spark, room = members.sparkSession, SHINGLES
    most, most_short = misses_allowed(how.percent, LONG, 5), misses_allowed(how.percent, how.size, 6)
    rest = members.join(hubs, ["bucket", "node"], "left_anti")
    sizes = rest.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    top = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("comps")
    )
    top = top.where("comps > 1").select(
        "bucket",
        F.col("top.comp").alias("top"),
        F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("minor_blocks"),
    )
    rows = stage(rest.join(top, "bucket"), scratch_path(spark, "near-open"))
    nodes = rows.select("node").distinct()
    signed = long_signatures(sets.join(nodes, "node", "left_semi"), how).join(reps, "node")
    rows = rows.join(stage(signed, scratch_path(spark, "near-long")), "node").withColumn("h", F.xxhash64("node"))
    rows = rows.where(F.array_contains("bands", F.col("bucket")))  # of a doc_id's texts, the one meant

    def spread(own: str, other: str, minor: bool) -> DataFrame:
        mine = F.pmod("h", F.col(own)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        df = rows.where(F.col("comp") != F.col("top")) if minor else rows
        first, second = (mine, theirs) if minor else (theirs, mine)
        place = [first.alias("i"), second.alias("j"), F.lit(minor).alias("minor")]
        return df.select("bucket", *place, "node", "comp", "n_shingles", "sig", "long", "bands")

    spread_rows = spread("minor_blocks", "blocks", True).union(spread("blocks", "minor_blocks", False))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(key, held):
            minor = [r for r in held if r["minor"]]
            every = [r for r in held if not r["minor"]]
            if not minor or not every:
                return
            longs = np.frombuffer(b"".join(r["long"] for r in every), dtype=np.uint64).reshape(len(every), -1)
            bands = np.array([r["bands"] for r in every], dtype=np.int64)
            short = np.array([r["sig"] for r in every], dtype=np.int64).view(np.uint64)
            size = np.array([r["n_shingles"] for r in every])
            comp = np.array([r["comp"] for r in every])
            node = np.array([r["node"] for r in every])
            near = np.zeros(len(every), dtype=bool)
            found = {}
            for r in minor:
                low, high = np.minimum(size, r["n_shingles"]), np.maximum(size, r["n_shingles"])
                hit = np.flatnonzero((comp != r["comp"]) & (100 * low >= how.percent * high))
                own = np.array(r["sig"], dtype=np.int64).view(np.uint64)
                hit = hit[differing(short[hit], own) <= most_short]
                hit = hit[differing(longs[hit], np.frombuffer(r["long"], dtype=np.uint64)) <= most]
                own = np.array(r["bands"], dtype=np.int64)
                hit = hit[own[(bands[hit] == own).argmax(axis=1)] == key[0]]
                near[hit] = True
                if len(hit):
                    found[r["node"]] = (r["comp"], r["n_shingles"])
            if found:
                others = {n: (c, z) for n, c, z in zip(node[near].tolist(), comp[near].tolist(), size[near].tolist())}
                yield meeting(*key, found, others, room)

        key, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                own = (row["bucket"], row["i"], row["j"])
                if own != key:
                    yield from flush(key, held)
                    key, held = own, []
                held.append(row)
        yield from flush(key, held)

    return spread_rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(compare, MEETING)


def leftover_pairs(
    members: DataFrame, hubs: DataFrame, roots: DataFrame, sets: DataFrame, reps: DataFrame, how: MinHash
) -> DataFrame:
    """Links between components within a bucket, confirmed on full sets. A task leaves out those that
    join what its other links have joined."""
    spark = members.sparkSession
    rows = stage(candidates(labelled(members, roots), hubs, sets, reps, how), scratch_path(spark, "near-meet"))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in MEETS))
            rows = zip(*(batch.column(k).to_pylist() for k in ("minor", "node", "comp", "shingles")))
            for own, row in zip(keys, rows):
                if own != key:
                    yield linked(held, how)
                    key, held = own, []
                held.append(row)
        yield linked(held, how)

    return (
        rows.join(sets, "node")
        .repartition(*MEETS)
        .sortWithinPartitions(*MEETS)
        .mapInArrow(links, "a long, b long")
    )


def same_ids(known: DataFrame, repeats: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of a doc_id that comes with different texts."""
    split = repeats.where("low <> high").select("doc_id")
    own = known.join(split, "doc_id", "left_semi").join(classes, ["set_a", "set_b", "n_shingles"]).select("doc_id", "rep")
    least = own.groupBy("doc_id").agg(F.min("rep").alias("b"))
    return own.select("doc_id", F.col("rep").alias("a")).join(least, "doc_id").where("a <> b").select("a", "b")


def near_duplicates(docs: DataFrame, how: MinHash = MinHash()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    spark = docs.sparkSession

    def staged(df: DataFrame, name: str) -> DataFrame:
        return stage(df, scratch_path(spark, f"near-{name}"))

    digest = staged(digests(docs, how), "digest")
    known = digest.where("doc_id IS NOT NULL AND n_shingles > 0")
    key = ["set_a", "set_b", "n_shingles"]
    first = F.min(F.struct("doc_id", "sig", "bands")).alias("first")
    classes = known.groupBy(*key).agg(first).select(*key, F.col("first.doc_id").alias("rep"), "first.sig", "first.bands")
    classes = staged(classes, "classes")
    reps = classes.select(F.col("rep").alias("node"), "n_shingles", "sig", "bands")
    same = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("set_a").alias("low"), F.max("set_a").alias("high"))
    repeats = staged(same.where("n > 1").select("doc_id", "low", "high"), "repeats")
    repeated = not repeats.isEmpty()

    # A bucket's hub goes by a hash; buckets of one member have nothing to compare.
    banded = reps.select("node", F.explode("bands").alias("bucket"))
    pick = F.min(F.struct(F.xxhash64("node", "bucket").alias("h"), "node")).alias("pick")
    hubs = banded.groupBy("bucket").agg(pick, F.min("node").alias("low"), F.max("node").alias("high"))
    hubs = staged(hubs.where("low <> high").select("bucket", F.col("pick.node").alias("node")), "hubs")
    met = banded.join(hubs.withColumnRenamed("node", "hub"), "bucket").repartition("bucket", "node").distinct()
    met = staged(met, "members")
    members = met.select("bucket", "node")
    star = met.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    x, y = (
        reps.select(F.col("node").alias(n), F.col("sig").alias(f"sig_{n}"), F.col("n_shingles").alias(f"size_{n}"))
        for n in "ab"
    )
    alike = misses("sig_a", "sig_b", how.size // PER_LONG) <= misses_allowed(how.percent, how.size, 6)
    alike = alike & (100 * F.least("size_a", "size_b") >= how.percent * F.greatest("size_a", "size_b"))
    pairs = staged(star.join(x, "a").join(y, "b").where(alike).select("a", "b"), "pairs")

    # Full sets only of documents that some candidate needs, and of repeated rows once.
    wanted = members.select("node").distinct()
    own = docs.select(F.col("doc_id").cast("long"), "text")
    if repeated:
        again = own.join(repeats, "doc_id", "left_semi").withColumn("version", F.xxhash64("text"))
        again = again.dropDuplicates(["doc_id", "version"]).select("doc_id", "text")
        own = own.join(repeats, "doc_id", "left_anti").union(again)
    sets = staged(sets_of(own.join(wanted, own.doc_id == wanted.node, "left_semi"), how), "sets")
    links = confirm(pairs, sets, how)
    links = staged(links.union(same_ids(known, repeats, classes)) if repeated else links, "links")
    roots = components(links, "near-stars")

    # What these links join are whole components, by their roots.
    more = leftover_pairs(members, hubs, roots, sets, reps, how)
    for end in ("a", "b"):
        to = roots.select(F.col("node").alias(end), "root")
        more = more.join(to, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    merged = components(staged(more.where("a <> b").distinct(), "more"), "near-stars")

    found = labelled(classes.select(*key, F.col("rep").alias("node")), roots)
    found = labelled(found.select(*key, F.col("comp").alias("node")), merged)
    found = found.select(*key, F.col("comp").alias("component_id"))
    with_key = known.join(found, key)
    alone = digest.where("doc_id IS NULL OR n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    out = with_key.select("doc_id", "n_shingles", "component_id").union(
        alone.select("doc_id", "n_shingles", "component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
