"""SetSketch near-duplicate detection (operator 3).

1. Every text becomes its set of 5-word shingles (64-bit hashes) and a SetSketch: register i
   holds ``floor(1 - log_b(x_i))`` of the smallest exponential value x_i over the set,
   truncated to 0..Q+1. Registers of a union are the maxima, so sketches merge.
2. Rows with equal sets form a class; only one representative per class goes on.
3. Registers are banded. Each bucket links its members to its smallest id (a star, no pairs), the
   pairs are filtered by a joint maximum-likelihood estimate of the similarity from the
   register comparison and the exact set sizes, and confirmed on the full shingle sets.
4. Connected components follow from the confirmed links. In buckets of several components, the
   rows outside the largest one try one member of it; where components remain apart,
   every such row meets every row of the other components, in blocks, on the sketches;
   survivors are confirmed on the full sets: singly, or in blocks against a whole component
   or a whole cell where they would be many.

Buckets have no cap. A link of similarity >= 0.75 is missed only if all 32 bands of four
registers differ (below 5e-6 at 0.75) or the estimate is off by over six standard deviations.

Defined results: null, empty and blank texts have no shingles, are linked with nothing, get
their own id as ``component_id`` and are kept. Fewer than five words: the whole sequence is one
shingle. Repeated rows are each returned with the same class; rows without an id take the
class of their text, and an all-null class has a null ``component_id``. An empty table gives
an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import PIECE, Scratch, bitmap, documents, keyed_min, map_text, maybe_in, pieces, surely_not_in

K = 5
THRESHOLD_NUM, THRESHOLD_DEN = 75, 100
M = 128                      # registers
BAND = 4                     # registers in a band
BANDS = M // BAND
BASE, RATE, Q = 1.001, 20.0, (1 << 16) - 2
SIGMAS = 6
BLOCK = 512                  # rows of a bucket block compared at once
SET_BLOCK = 128              # full sets of a block
ID_BITS = 1 << 25            # of the bitmaps of ids, 4 MB
FEW = 2                      # likely pairs of a row with one component that are confirmed singly
#: Lowest estimate that can belong to a linked pair: six standard deviations below 0.75.
LEAST = 0.75 - SIGMAS * math.sqrt(0.75 * 0.25 / M)

_RNG = np.random.default_rng(20240501)
_POS = _RNG.integers(0, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _RNG.integers(0, 1 << 63, M, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---------------------------------------------------------------- sets and sketches

def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles (bytes.lower and bytes.split act
    on ASCII only)."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < K:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - K + 1
    s = h[:n] * _POS[0]
    for k in range(1, K):
        s += h[k:n + k] * _POS[k]
    s ^= s >> np.uint64(31)
    s *= np.uint64(0x9E3779B97F4A7C15)
    s ^= s >> np.uint64(29)
    return np.unique(s)


def minima(s: np.ndarray) -> np.ndarray:
    """Smallest hash of the set under each of M multipliers; blocks bound the memory."""
    low = np.full(M, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 1024):
        np.minimum(low, (_MUL[:, None] * s[None, i:i + 1024]).min(axis=1), out=low)
    return low


def registers(low: np.ndarray) -> np.ndarray:
    """SetSketch registers of the minima: exponentially spaced and truncated."""
    u = (low.astype(np.float64) + 0.5) / 2.0 ** 64
    x = -np.log1p(-np.minimum(u, 1 - 2.0 ** -53)) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, Q + 1).astype("<u2")


def estimate(d_plus, d_minus, n_u, n_v) -> np.ndarray:
    """Joint maximum-likelihood estimate of the Jaccard similarity of pairs of sketches.

    d_plus / d_minus: registers in which the first / second is larger; n_u, n_v: set sizes.
    The log-likelihood is concave in J, so the maximum is bisected on its derivative.
    """
    d_plus, d_minus = np.asarray(d_plus, float), np.asarray(d_minus, float)
    d_zero = M - d_plus - d_minus
    u = np.asarray(n_u, float) / (np.asarray(n_u, float) + np.asarray(n_v, float))
    v = 1 - u
    c = (BASE - 1) / BASE
    log_b = math.log(BASE)
    lo, hi = np.zeros_like(u), np.minimum(u / v, v / u) * (1 - 1e-12)

    def slope(j):
        a, b = np.maximum(u - v * j, 1e-15), np.maximum(v - u * j, 1e-15)
        pa_, pb = -np.log1p(-a * c) / log_b, -np.log1p(-b * c) / log_b
        da, db = -v * c / (1 - a * c) / log_b, -u * c / (1 - b * c) / log_b
        p0 = np.maximum(1 - pa_ - pb, 1e-15)
        return d_plus * da / pa_ + d_minus * db / pb - d_zero * (da + db) / p0

    for _ in range(40):
        mid = (lo + hi) / 2
        up = slope(mid) > 0
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
    return (lo + hi) / 2


def _signature_maker():
    import xxhash

    def fn(texts):
        n, keys, sigs = [], [], []
        for t in texts:
            s = shingles(t)
            n.append(len(s))
            keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            sigs.append(registers(minima(s)).tobytes() if len(s) else None)
        return [pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())]

    return fn


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit digest of the set), sig (registers, little-endian)."""
    out = [T.StructField("n_shingles", T.LongType()), T.StructField("set_key", T.BinaryType()),
           T.StructField("sig", T.BinaryType())]
    return map_text(docs, text_col, [id_col], out, _signature_maker).toDF(
        "doc_id", "n_shingles", "set_key", "sig")


def _set_maker():
    def fn(texts):
        return [pa.array([shingles(t).tobytes() for t in texts], pa.binary())]

    return fn


# ---------------------------------------------------------------- candidate links

def buckets(reps: DataFrame) -> DataFrame:
    """(bucket, id) of every representative and band, buckets of one row left out."""
    width = 2 * BAND
    rows = reps.select(F.col("id"), F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring("sig", b * width + 1, F.lit(width))))).alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(shared.select("bucket"), "bucket")


def _compare(a, b):
    x, y = (np.frombuffer(b"".join(v), "<u2").reshape(-1, M) for v in (a, b))
    return (x > y).sum(axis=1), (x < y).sum(axis=1)


def likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose joint estimate leaves a similarity of 0.75 possible."""
    left = reps.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
    right = reps.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            plus, minus = _compare(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())
            yield batch.select(["a", "b"]).filter(pa.array(estimate(plus, minus, na, nb) >= LEAST))

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full shingle sets have 100 * intersection >= 75 * union."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = 0
                if THRESHOLD_DEN * min(len(x), len(y)) >= THRESHOLD_NUM * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(THRESHOLD_DEN * both >= THRESHOLD_NUM * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, comp): the smallest id reachable over ``links`` (a, b), for every id in a link.

    Smallest label of the neighbours, then label of the label, until nothing changes; each
    round is written, so no lineage builds up.
    """
    edges = scratch.table(links.union(links.select("b", "a")).distinct().toDF("a", "b"), f"{name}-e")
    labels = scratch.table(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                           .select("id", F.least("id", "m").alias("comp")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = (edges.join(labels, edges.b == labels.id).groupBy(F.col("a").alias("id"))
                .agg(F.min("comp").alias("m")))
        hooked = (labels.join(near, "id")
                  .select("id", F.col("comp").alias("old"), F.least("comp", "m").alias("c")))
        jump = labels.select(F.col("id").alias("c"), F.col("comp").alias("up"))
        new = scratch.table(hooked.join(jump, "c", "left").select(
            "id", F.least("c", "up").alias("comp"), "old"), f"{name}-{turn}")
        done = new.where("comp <> old").isEmpty()
        scratch.release(f"{name}-{turn - 1}", labels.schema)
        labels = new.select("id", "comp")
        if done:
            return labels


def labelled(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """(bucket, id, comp) of the bucket rows; a row without links is its own component."""
    return rows.join(comp, "id", "left").select("bucket", "id", F.coalesce("comp", "id").alias("comp"))


def mixed(members: DataFrame) -> DataFrame:
    """Buckets of several components: rows ``n``, largest component ``main`` and its rows ``n_main``."""
    per = members.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    return (per.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("k"),
                                      F.max(F.struct("n", "comp")).alias("top")).where("k > 1")
            .select("bucket", "n", F.col("top.comp").alias("main"), F.col("top.n").alias("n_main")))


def second_star(members: DataFrame) -> DataFrame:
    """Pairs of each row outside its bucket's largest component with one member of that, drawn by hash."""
    rows = members.join(mixed(members).select("bucket", "main"), "bucket")
    lead = (rows.where("comp = main").groupBy("bucket")
            .agg(F.min_by("id", F.xxhash64("bucket", "id")).alias("l")))
    return (rows.where("comp <> main").join(lead, "bucket")
            .select(F.least("id", "l").alias("a"), F.greatest("id", "l").alias("b")).distinct())


def cross_blocks(members: DataFrame, reps: DataFrame) -> DataFrame:
    """What is likely to be linked across components in one bucket, over all rows of the bucket, as
    CELL_ROWS: pairs (a, b); (a, comp) where a row is like more than FEW members of a component;
    the rows of a cell, with its key, where its likely pairs outnumber them.

    ``members``: (bucket, id, comp). Rows outside the bucket's largest component (guests) meet
    every row of the bucket (home) in cells of a block of homes and a block of guests, at most
    about BLOCK rows each, so no task gathers a bucket, and what leaves a cell is
    in proportion to its rows.
    """
    size = mixed(members).select("bucket", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("hs"),
                                 F.ceil((F.col("n") - F.col("n_main")) / BLOCK).cast("int").alias("gs"))
    rows = members.join(size, "bucket").withColumn("guest", F.col("comp") != F.col("main"))
    h = F.xxhash64("id")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    home = rows.select("*", F.pmod(h, "hs").cast("int").alias("hb")).withColumn("gb", every("gs"))
    guests = (rows.where("guest").select("*", F.pmod(h, "gs").cast("int").alias("gb"))
              .withColumn("hb", every("hs")))
    cols = ["bucket", "hb", "gb", "id", "comp", "guest"]
    cells = (home.select(*cols, F.lit(False).alias("visits"))
             .union(guests.select(*cols, F.lit(True).alias("visits")))
             .join(reps, "id")
             .repartition("bucket", "hb", "gb").sortWithinPartitions("bucket", "hb", "gb", "visits", "id"))

    def likely_pairs(t):
        """Pairs in a table of whole cells, rows in cell order with the guests last."""
        col = {c: t.column(c).to_numpy() for c in ("bucket", "hb", "gb", "id", "comp", "n_shingles")}
        guest, visits = (t.column(c).to_numpy(zero_copy_only=False) for c in ("guest", "visits"))
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), "<u2").reshape(-1, M)
        edge = np.flatnonzero((np.diff(col["bucket"]) != 0) | (np.diff(col["hb"]) != 0)
                              | (np.diff(col["gb"]) != 0)) + 1
        cell_of = np.searchsorted(edge, np.arange(len(visits)), side="right")
        found = []
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(visits)]):
            m = a + int(np.count_nonzero(~visits[a:b]))
            if m == a or m == b:
                continue
            ids, comp, n = (col[c][a:b] for c in ("id", "comp", "n_shingles"))
            k = m - a
            i, j = np.nonzero((comp[:k, None] != comp[None, k:])
                              & (~guest[a:m, None] | (ids[:k, None] < ids[None, k:]))
                              & (THRESHOLD_DEN * np.minimum(n[:k, None], n[None, k:])
                                 >= THRESHOLD_NUM * np.maximum(n[:k, None], n[None, k:])))
            found.append((i + a, j + m))
        if not found:
            return
        left, right = (np.concatenate(x) for x in zip(*found))
        for s in range(0, len(left), 8192):
            i, j = left[s:s + 8192], right[s:s + 8192]
            x, y = sig[i], sig[j]
            ok = estimate((x > y).sum(axis=1), (x < y).sum(axis=1),
                          col["n_shingles"][i], col["n_shingles"][j]) >= LEAST
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            to = np.column_stack((col["id"][j], col["comp"][i]))
            whole, at, n = np.unique(to, axis=0, return_inverse=True, return_counts=True)
            few, whole = n[at.ravel()] <= FEW, whole[n > FEW]
            yield cell_rows(a=whole[:, 0], comp=whole[:, 1])
            i, j = i[few], j[few]
            # a cell of many small components: its rows go on, not its pairs
            for cell in np.unique(cell_of[j]):
                x, y = i[cell_of[j] == cell], j[cell_of[j] == cell]
                rows = np.concatenate((np.unique(x), np.unique(y)))
                if len(x) <= len(rows):
                    a, b = col["id"][x], col["id"][y]
                    yield cell_rows(a=np.minimum(a, b), b=np.maximum(a, b))
                else:
                    yield cell_rows(a=col["id"][rows], comp=col["comp"][rows], bucket=col["bucket"][rows],
                                    hb=col["hb"][rows], gb=col["gb"][rows], visits=visits[rows])

    run = whole_cells(("bucket", "hb", "gb"), likely_pairs)
    return cells.mapInArrow(run, CELL_ROWS).distinct()


CELL_ROWS = "a long, b long, comp long, bucket long, hb int, gb int, visits boolean"


def cell_rows(**cols) -> pa.RecordBatch:
    """Rows of CELL_ROWS with nulls in the columns that are not given."""
    kinds = dict(a=pa.int64(), b=pa.int64(), comp=pa.int64(), bucket=pa.int64(), hb=pa.int32(), gb=pa.int32(),
                 visits=pa.bool_())
    n = len(cols["a"])
    return pa.record_batch([pa.array(np.ascontiguousarray(cols[c]), k) if c in cols else pa.nulls(n, k)
                            for c, k in kinds.items()], list(kinds))


def whole_cells(keys: tuple[str, ...], process):
    """A batch function that gives ``process`` tables of whole cells from rows sorted by ``keys``."""
    def run(batches):
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = (t if rest is None else pa.concat_tables([rest, t])).combine_chunks()
            last = np.zeros(t.num_rows, bool)
            for c in keys:
                v = t.column(c).to_numpy()
                last |= v != v[-1]
            cut = np.flatnonzero(last)
            cut = int(cut[-1]) + 1 if len(cut) else 0
            if cut:
                yield from process(t.slice(0, cut).combine_chunks())
            rest = t.slice(cut)
        if rest is not None and rest.num_rows:
            yield from process(rest.combine_chunks())

    return run


def linked_to_component(tasks: DataFrame, comp: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of each task (a, comp): a row against all members of a component, on full sets.

    One link to a component is enough, as its members hang together already. Members and
    rows meet in cells of at most about SET_BLOCK each; a cell holds their sets and returns
    links only, so neither rows nor time grow with pairs that are alike but not linked.
    """
    size = (comp.join(tasks.select("comp").distinct(), "comp").groupBy("comp").agg(F.count("*").alias("n"))
            .join(tasks.groupBy("comp").agg(F.count("*").alias("m")), "comp")
            .select("comp", F.ceil(F.col("n") / SET_BLOCK).cast("int").alias("hs"),
                    F.ceil(F.col("m") / SET_BLOCK).cast("int").alias("gs")))
    h = F.xxhash64("id")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    home = (comp.join(size, "comp").select("comp", "id", F.pmod(h, "hs").cast("int").alias("hb"), "gs")
            .select("comp", "id", "hb", every("gs").alias("gb"), F.lit(False).alias("visits")))
    guests = (tasks.select("comp", F.col("a").alias("id")).join(size, "comp")
              .select("comp", "id", F.pmod(h, "gs").cast("int").alias("gb"), "hs")
              .select("comp", "id", every("hs").alias("hb"), "gb", F.lit(True).alias("visits")))
    cells = home.unionByName(guests).withColumn("own", F.when(F.col("visits"), -1).otherwise(F.col("comp")))
    return linked_in_cells(cells, ("comp", "hb", "gb"), sets)


def linked_in_cells(cells: DataFrame, keys: tuple[str, ...], sets: DataFrame) -> DataFrame:
    """Links (a, b) between the rows at home in a cell and its guests, on full sets: for each guest
    one per component (``own``) other than its own. Only links leave a cell."""
    whole = cells.join(sets, "id").repartition(*keys).sortWithinPartitions(*keys, "visits", "id")

    def links(t):
        ids, own = t.column("id").to_numpy(), t.column("own").to_numpy()
        visits = t.column("visits").to_numpy(zero_copy_only=False)
        at = np.column_stack([t.column(c).to_numpy() for c in keys])
        edge = (np.flatnonzero((np.diff(at, axis=0) != 0).any(axis=1)) + 1).tolist()
        raw = t.column("shingles").combine_chunks()
        out = []
        for s, e in zip([0, *edge], [*edge, len(ids)]):
            m = s + int(np.count_nonzero(~visits[s:e]))
            if m == s or m == e:
                continue
            held = [np.frombuffer(raw[i].as_buffer(), np.uint64) for i in range(s, m)]
            sizes = np.array([len(x) for x in held])
            values = np.concatenate(held)
            order = np.argsort(values, kind="stable")
            values, owner = values[order], np.repeat(np.arange(m - s), sizes)[order]
            for g in range(m, e):
                x = np.frombuffer(raw[g].as_buffer(), np.uint64)
                lo, hi = np.searchsorted(values, x, "left"), np.searchsorted(values, x, "right")
                n = hi - lo
                place = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                both = np.bincount(owner[place], minlength=m - s)
                hit = np.flatnonzero((THRESHOLD_DEN * both >= THRESHOLD_NUM * (sizes + len(x) - both))
                                     & (own[s:m] != own[g]))
                for k in hit[np.unique(own[s:m][hit], return_index=True)[1]]:
                    out.append((int(min(ids[g], ids[s + k])), int(max(ids[g], ids[s + k]))))
        yield pa.record_batch([pa.array([x[0] for x in out], pa.int64()),
                               pa.array([x[1] for x in out], pa.int64())], ["a", "b"])

    return whole.mapInArrow(whole_cells(keys, links), "a long, b long").distinct()


# ---------------------------------------------------------------- the operator

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "near-dedup")
    sk = scratch.table(sketches(docs, id_col, text_col), "sketches")
    # a class is known by its smallest id; a class without any id takes part in nothing
    one = F.struct("n_shingles", "sig")
    classes = (sk.where("set_key is not null and doc_id is not null").groupBy("set_key")
               .agg(F.min("doc_id").alias("id"), F.any_value(one).alias("x"))
               .select("id", "x.n_shingles", "x.sig"))
    reps = scratch.table(classes, "reps")
    rows = scratch.table(buckets(reps), "buckets")

    # star links of every bucket to its smallest id
    lead = rows.groupBy("bucket").agg(F.min("id").alias("a"))
    star = rows.join(lead, "bucket").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    pairs = scratch.table(likely(star, reps), "pairs")
    sets = shingle_sets(docs, rows, scratch, id_col, text_col)
    links = scratch.table(confirmed(pairs, sets), "links")
    comp = components(links, scratch, "first")

    # those still outside the largest component of a bucket: to one member of that component
    members = scratch.table(labelled(rows, comp), "members")
    near = scratch.table(likely(second_star(members), reps).join(pairs, ["a", "b"], "left_anti"), "near")
    more = scratch.table(confirmed(near, sets), "more")
    if not more.isEmpty():
        links, pairs = links.union(more), pairs.union(near)
        comp = components(links, scratch, "second")
        members = scratch.table(labelled(rows, comp), "members-2")

    # what is left of them: to every row of the bucket, block by block
    rest = scratch.table(cross_blocks(members, reps), "rest")
    single = rest.where("b is not null").select("a", "b").join(pairs, ["a", "b"], "left_anti")
    tasks = rest.where("b is null and bucket is null").select("a", "comp")
    dense = rest.where("bucket is not null").select("bucket", "hb", "gb", "visits", F.col("a").alias("id"),
                                                    F.col("comp").alias("own"))
    extra = scratch.table(confirmed(single, sets).union(linked_to_component(tasks, comp, sets))
                          .union(linked_in_cells(dense, ("bucket", "hb", "gb"), sets)).distinct(), "extra")
    if not extra.isEmpty():
        comp = components(links.union(extra), scratch, "last")

    label = comp.select(F.col("id").alias("rep"), "comp")
    out = keyed_min(sk.select("doc_id", "n_shingles", "set_key"), "set_key", "doc_id", "rep",
                    lambda t: t.join(label, "rep", "left"))
    own = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.coalesce("comp", "rep"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"),
                      F.col("doc_id").eqNullSafe(own).alias("kept"))


def shingle_sets(docs, rows, scratch, id_col, text_col) -> DataFrame:
    """(id, shingles) of the rows that share a bucket, computed from the whole texts. A bitmap of the
    ids keeps most other texts out of the join."""
    ids = scratch.table(rows.select("id").distinct(), "shared-ids")
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    made = scratch.table(pieces(bitmap(ids, F.col("id"), ID_BITS)), "shared-bitmap")
    near = maybe_in(src, F.col("id"), made, ID_BITS, 8 * PIECE)
    texts = near.join(ids, "id", "left_semi")
    made = map_text(texts, "text", ["id"], [T.StructField("shingles", T.BinaryType())], _set_maker)
    return scratch.table(made.groupBy("id").agg(F.any_value("shingles").alias("shingles")), "sets")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (the one with the smallest id); of
    repeated rows one stays as well. Rows without an id cannot be told apart: all stay if one does.

    Of most ids one row stays, and nothing is to be done. Only the others are told by a join; a bitmap of them lets
    every document that is surely none of them pass as it is read, so its text enters no shuffle.
    """
    scratch = Scratch(spark, "near-dedup-stage")
    inner = Scratch(spark, "near-dedup")
    per = near_duplicates(docs, scratch=inner).groupBy(F.col("doc_id").alias("_id")).agg(F.count_if("kept").alias("_kept"))
    odd = scratch.table(per.where("_kept <> 1"), "odd")
    inner.clear()                   # only the ids are read from here on
    made = scratch.table(pieces(bitmap(odd, F.col("_id"), ID_BITS)), "odd-bitmap")
    others = maybe_in(docs, F.col("doc_id"), made, ID_BITS, 8 * PIECE)
    same = docs["doc_id"].eqNullSafe(odd["_id"])
    once = surely_not_in(docs, F.col("doc_id"), made, ID_BITS, 8 * PIECE).unionAll(others.join(odd, same, "left_anti"))
    repeated = odd.where("_kept > 1")
    if repeated.isEmpty():
        return once
    return once.unionAll(others.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))
