"""MinHash near-duplicate detection with circulant signatures.

Two permutations of the 32-bit numbers make the whole signature: sigma breaks
the structure of the shingle hashes, pi is applied to sigma(s) shifted
circularly by k = 0 .. K-1, and coordinate k is the least pi(sigma(s) - k).
Signatures are cut into bands; documents that agree on a band meet in a
bucket, and a pair becomes a link only by exact Jaccard of the full shingle
sets, 100 * |A & B| >= 75 * |A | B|.

Copies with equal shingle sets are one node from the start. Buckets of up to
eight nodes are compared in full; a larger one belongs to the group of its hub, the member that
meets most others. A group's core is what most of its members hold, and its representative
the member that has most of it; all members are held against that one. Those that don't join its component are compared
further only where that can matter: what two of them share lies in the core or beyond it, the first part is
bounded by what each has of the core, and where that is too little they must share a shingle
beyond it, by which they are joined. So a group of near copies costs one pair per member, and
every pair that shares a band and could link is verified unless other links join it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import materialise
from plotwise.operators.cluster import connected_components

SHINGLE = 5
THRESHOLD = 75          # per cent
ROWS, BANDS = 4, 32     # a pair at 0.75 shares no band with probability 5e-6
COORDS = ROWS * BANDS
#: A pair needs this many equal 8-bit coordinates of 128 to be worth its exact test:
#: at 0.75 similarity 96 are expected, and fewer than 72 have probability 4e-7.
LEAST_EQUAL = 72
FEW = 8                 # buckets of up to this size are compared in full
HOPS = 3                # links that a label travels between rounds
CLASSES = 1 << 20       # hash classes of ids that a broadcast may name
BLOCK = 512             # shingles per block of the signature's inner loop

_U64 = np.uint64
_MULT, _MIX = _U64(0x9E3779B97F4A7C15), _U64(0xBF58476D1CE4E5B9)
_SHIFTS = np.arange(COORDS, dtype=np.uint32)


def _stir(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U64(30))) * _MIX
    return h ^ (h >> _U64(27))


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles, ascending. Bytes are lowered
    (A-Z only) and split at ASCII white space; fewer than ``width`` words make
    one shingle of the whole sequence; no words, an empty set."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    span, count = (width, n - width + 1) if n >= width else (n, 1)
    h = np.full(count, span, dtype=np.uint64)
    for j in range(span):
        h = _stir(h * _MULT + w[j:j + count])
    return np.unique(h)


def _permute(x: np.ndarray) -> np.ndarray:
    """pi, in place: a bijection of the 32-bit numbers (xor-shifts and odd multiplications)."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 128 circulant coordinates of a set that isn't empty."""
    sigma = (shingles >> _U64(32)).astype(np.uint32)
    sigma = (sigma ^ (sigma >> np.uint32(15))) * np.uint32(0x2C1B3C6D)      # sigma: another bijection
    sigma ^= sigma >> np.uint32(12)
    least = np.full(COORDS, 0xFFFFFFFF, dtype=np.uint32)
    for a in range(0, len(sigma), BLOCK):
        shifted = sigma[a:a + BLOCK, None] - _SHIFTS[None, :]
        np.minimum(least, _permute(shifted).min(axis=0), out=least)
    return least


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _MULT
    for j in range(ROWS):
        h = _stir(h * _MULT + rows[:, j])
    return h.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands, sigs = [], [], [], []
        for text in batch.column(1):
            s = shingle_set(text.as_py())
            sizes.append(len(s))
            if len(s):
                sig = signature(s)
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                bands.append(band_keys(sig))
                sigs.append(sig.astype(np.uint8).tobytes())
            else:
                keys.append(None)
                bands.append(None)
                sigs.append(None)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
            pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
            names=["id", "n_shingles", "node", "bands", "sig"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
            pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "shingles"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose 8-bit signatures agree often enough."""
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, COORDS) for c in (2, 3))
            keep = pa.array((a == b).sum(axis=1) >= LEAST_EQUAL)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in (0, 1, 4, 5)], names=["a", "b", "id_a", "id_b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    component_id is the smallest id reachable over links, kept says that the row
    is it. Null or empty text and text without words has an empty set and is linked
    with nothing. Rows of one id are one document; a row with a null id is linked with
    nothing, has a null component and is kept. Extra columns are not read. An
    empty table gives an empty table.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketches = materialise(src.mapInArrow(
        _sketch, "id long, n_shingles long, node binary, bands array<long>, sig binary"), "near-sketch")
    named = sketches.filter("id is not null and node is not null")
    rows = named.select("id", "node")
    # equal sets are one node; ids with several texts tie their nodes together
    heads = named.groupBy("node").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "sig")])
    ties = (rows.groupBy("id").agg(F.min("node").alias("src"), F.max("node").alias("last")).filter("src != last")
                .join(rows, "id").filter("node != src").select("src", F.col("node").alias("dst")))
    edges = _links(src, heads).unionByName(ties)
    comps = connected_components(_ends(edges), edges, "node").withColumnRenamed("node", "n")
    placed = rows.join(comps, F.col("node") == F.col("n"), "left").select("id", "node", F.coalesce("component", "node").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    of_node = (placed.select("node", "component").distinct().join(smallest, "component")
                     .select(F.col("node").alias("n"), "component_id"))
    return (sketches.select("id", "n_shingles", "node").join(of_node, F.col("node") == F.col("n"), "left")
                    .withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")))
                    .select(F.col("id").alias(id_col), "n_shingles", "component_id",
                            (F.col("id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept")))


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()


def _labels(links: DataFrame) -> DataFrame:
    """labelled, label: least node within ``HOPS`` links. Equal labels mean one
    component; different ones may still be one, which only costs further tests."""
    both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    found = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("label"))
    for _ in range(HOPS - 1):
        found = (both.join(found.withColumnRenamed("src", "via"), F.col("dst") == F.col("via"))
                     .groupBy("src").agg(F.least(F.min("label"), F.col("src")).alias("label")))
    return found.withColumnRenamed("src", "labelled")


def _links(src: DataFrame, heads: DataFrame) -> DataFrame:
    """src, dst (nodes): verified links that join all nodes that LSH brings together."""
    met = heads.select("node", F.explode("bands").alias("bucket"))
    buckets = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialise(met.join(buckets, "bucket"), "near-buckets")
    facts = materialise(heads.drop("bands").join(members.select("node").distinct(), "node"), "near-facts")
    few, many = members.filter(F.col("n") <= FEW), members.filter(F.col("n") > FEW)
    small = few.select("bucket", "node").join(few.select("bucket", F.col("node").alias("other")), "bucket") \
               .filter("node < other").select(F.col("node").alias("a"), F.col("other").alias("b"))
    if many.isEmpty():
        return _verify(src, facts, small)
    # a text's bands agree with most of its copies' where it has few edits: the member whose buckets are fullest is the hub
    score = many.groupBy("node").agg(F.sum("n").alias("score"))
    hubs = many.join(score, "node").groupBy("bucket").agg(F.max(F.struct("score", "node")).alias("h")) \
               .select(F.col("bucket").alias("hb"), "h")
    star = _star(src, facts, _grouped(many.join(hubs, F.col("bucket") == F.col("hb"))))
    links = materialise(_verify(src, facts, small).unionByName(
        star.filter("node != rep").filter(F.col("common") * 7 >= (F.col("size") + F.col("rep_size")) * 3).select(F.col("rep").alias("src"), F.col("node").alias("dst"))), "near-links")
    labels = _labels(links)
    of_rep = labels.select(F.col("labelled").alias("f"), F.col("label").alias("rep_label"))
    placed = (star.join(labels, F.col("node") == F.col("labelled"), "left").join(of_rep, F.col("rep") == F.col("f"), "left")
                  .select("hub", "node", "size", "core", "others", F.coalesce("label", "node").alias("label"),
                          (F.coalesce("label", "node") != F.coalesce("rep_label", "rep")).alias("apart")))
    placed = materialise(placed, "near-placed")

    def other(rows: DataFrame) -> DataFrame:
        return rows.filter("apart").select(*[F.col(c).alias("l" + c) for c in ("hub", "node", "size", "core", "others", "label")])

    # pairs that the core's shingles alone could link, then pairs that need others in common and so share one of the least
    within = (placed.join(other(placed).filter("lcore * 100 >= lsize * 75"), (F.col("hub") == F.col("lhub")) & (F.col("label") != F.col("llabel"))
                          & (F.least("core", "lcore") * 7 >= (F.col("size") + F.col("lsize")) * 3)))
    ordered = materialise(_rarest_first(_in_reach(placed)), "near-ordered")
    beyond = _beyond(ordered, other(ordered))
    rest = within.select("node", "lnode").unionByName(beyond.select("node", "lnode")) \
                 .select(F.least("node", "lnode").alias("a"), F.greatest("node", "lnode").alias("b"))
    return links.unionByName(_verify(src, facts, rest))


def _grouped(met: DataFrame) -> DataFrame:
    """(hub, node), each once, of (bucket, node, h: the score and node of the bucket's hub). A bucket belongs to the group of the best
    hub that its own hub meets, so that the many small buckets beside a large group's lie in that group. All members of a
    bucket are in one group."""
    best = met.groupBy(F.col("node").alias("n")).agg(F.max("h").alias("b")).select("n", F.col("b.node").alias("hub"))
    return met.select(F.col("h.node").alias("own"), "node").distinct().join(best, F.col("own") == F.col("n")).select("hub", "node").distinct()


def _in_reach(placed: DataFrame) -> DataFrame:
    """Members of a group that could link with one that is apart by shingles beyond the core: at most the lesser core and the
    fewer others are shared, and a link asks for 3/7 of both sizes. Groups without any apart have none."""
    far = (placed.filter("apart").groupBy(F.col("hub").alias("fh"))
                 .agg(F.max("core").alias("fc"), F.max(F.size("others")).alias("fo"), F.min("size").alias("fs")))
    enough = (F.least("core", "fc") + F.least(F.size("others"), F.col("fo"))) * 7 >= (F.col("size") + F.col("fs")) * 3
    return placed.join(far, F.col("hub") == F.col("fh")).filter(F.col("apart") | enough).select(*placed.columns)


def _rarest_first(rows: DataFrame) -> DataFrame:
    """The others in order of the members here that hold them: what many members share stands last, beyond the places that count."""
    keys = [c for c in rows.columns if c != "others"]
    each = rows.select(*keys, F.explode_outer("others").alias("s"))
    counted = each.groupBy(F.col("hub").alias("oh"), F.col("s").alias("os")).agg(F.count(F.lit(1)).alias("n"))
    met = (each.join(counted, (F.col("hub") == F.col("oh")) & (F.col("s") == F.col("os")), "left")
               .groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(F.col("s").isNotNull(), F.struct("n", "s")))).alias("o")))
    return met.select(*keys, F.transform("o", lambda x: x["s"]).alias("others"))


def _star(src: DataFrame, facts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(hub, node): a group by its hub and its members, with rep, its member that has most of the core; size, rep_size,
    common (the node's shingles that rep has), core (those in the core) and the others.

    The core of a group is what more than half of its members hold, so at most twice their mean size; shingles that an
    edit of one member destroyed are still in it.
    """
    ids = facts.select("id", "node").join(pairs.select("node").distinct(), "node", "left_semi")
    sets = _sets_of(src, ids.select(F.col("id").alias("wid")), "near-star-sets")
    own = pairs.join(sets, "node").select("hub", "node", F.col("shingles").alias("x"))
    held = own.select("hub", F.explode("x").alias("s")).groupBy("hub", "s").agg(F.count(F.lit(1)).alias("n"))
    members = pairs.groupBy(F.col("hub").alias("mh")).agg(F.count(F.lit(1)).alias("all"))
    cores = (held.filter("n > 1").join(members, F.col("hub") == F.col("mh")).filter(F.col("n") * 2 > F.col("all"))
                 .groupBy(F.col("hub").alias("ch")).agg(F.collect_list("s").alias("c")))
    parts = (own.join(cores, F.col("hub") == F.col("ch"), "left").withColumn("others", F.when(F.col("c").isNull(), F.col("x")).otherwise(F.array_except("x", "c")))
                .select("hub", "node", F.size("x").alias("size"), (F.size("x") - F.size("others")).alias("core"), "others"))
    parts = materialise(parts, "near-core")
    reps = parts.groupBy(F.col("hub").alias("rh")).agg(F.max(F.struct(F.col("core") * 2 - F.col("size"), "node")).alias("r")).select("rh", F.col("r.node").alias("rep"))
    of_rep = reps.join(sets, F.col("rep") == F.col("node")).select("rh", "rep", F.col("shingles").alias("h"))
    met = own.select("hub", F.col("node").alias("n"), "x").join(of_rep, F.col("hub") == F.col("rh"))
    common = met.select(F.col("hub").alias("g"), "n", "rep", F.size("h").alias("rep_size"), F.size(F.array_intersect("x", "h")).alias("common"))
    return materialise(parts.join(common, (F.col("hub") == F.col("g")) & (F.col("node") == F.col("n"))).drop("g", "n"), "near-star")


def _beyond(placed: DataFrame, ahead: DataFrame) -> DataFrame:
    """(node, lnode) that must be tested for what they share beyond the core.

    Two members x, y have at most min(core_x, core_y) core shingles in common; a link asks for 3/7 of the sum of their sizes,
    so for k >= 3/7 (size_x + size_y) - core_x others in common. Two sets that share k elements meet within the first
    size - k + 1 of each in any order: at a place i (from 0) of x's others only if size_y <= (4 size_x - 7 i) / 3. As
    size_y is 3/4 size_x at least, places beyond a quarter of the size never count.
    """
    def sides(rows: DataFrame, p: str) -> DataFrame:
        size = F.col(p + "size")
        place = F.posexplode(F.slice(p + "others", F.lit(1), F.floor(size / 4).cast("int") + 1)).alias(p + "i", p + "s")
        return rows.select(F.col(p + "hub").alias(p + "h"), F.col(p + "node"), F.col(p + "label"), size.alias(p + "n"), F.col(p + "core").alias(p + "c"), place)

    # the most that they can share at all: the lesser core, and the fewer others
    most = F.least("c", "lc") + F.least(F.col("n") - F.col("c"), F.col("ln") - F.col("lc"))
    return sides(placed, "").join(sides(ahead, "l"), (F.col("h") == F.col("lh")) & (F.col("s") == F.col("ls")) & (F.col("label") != F.col("llabel"))
                                  & (F.col("ln") * 3 <= F.col("n") * 4 - F.col("i") * 7) & (F.col("n") * 3 <= F.col("ln") * 4 - F.col("li") * 7)
                                  & (most * 7 >= (F.col("n") + F.col("ln")) * 3)).select("node", "lnode")


def _sets_of(src: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """node, shingles of the texts of these ids, each set once. Before texts are shuffled, those whose id falls
    in none of the wanted ids' hash classes go: there are at most ``CLASSES``, a proven bound for the broadcast."""
    def cls(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(CLASSES))
    wanted = ids.distinct()
    likely = src.join(F.broadcast(wanted.select(cls("wid").alias("c")).distinct()), cls("id") == F.col("c"), "left_semi")
    holders = likely.join(wanted, F.col("id") == F.col("wid"), "left_semi").select("text")
    return materialise(holders.mapInArrow(_sets, "node binary, shingles array<long>").dropDuplicates(["node"]), name)


def _verify(src: DataFrame, facts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar enough, as src, dst."""
    fa, fb = (facts.select(F.col("node").alias(x), F.col("id").alias(f"id_{x}"), F.col("n_shingles").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
              for x in "ab")
    sized = (pairs.distinct().join(fa, "a").join(fb, "b")
                  .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * THRESHOLD).select("a", "b", "sa", "sb", "id_a", "id_b"))
    likely = materialise(sized.mapInArrow(_alike, "a binary, b binary, id_a long, id_b long"), "near-pairs")
    sets = _sets_of(src, likely.select(F.explode(F.array("id_a", "id_b")).alias("wid")), "near-sets")
    sa = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa"))
    sb = sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))
    both = F.size(F.array_intersect("xa", "xb"))
    return materialise(likely.select("a", "b").join(sa, "a").join(sb, "b")
                       .filter(both * 100 >= (F.size("xa") + F.size("xb") - both) * THRESHOLD)
                       .select(F.col("a").alias("src"), F.col("b").alias("dst")), "near-verified")
