"""Toxicity from gradient-boosted trees over dense features (operator 6).

Every whole text becomes a short vector of rates (``FEATURES``): density of a lexicon of insults
and of word beginnings learned from the labels, their hits near a second-person word, the
same after undoing obfuscations (digits and signs for letters, letters apart, masked letters),
capitals, punctuation. The learned beginnings are those whose documents are toxic far beyond chance
(log-likelihood ratio), counted by Spark. Gradient-boosted trees on the logistic loss are fitted in numpy;
isotonic regression turns the trees' margins into probabilities.

A bounded sample of labelled rows is dealt into parts by a hash of the id. Part 0 calibrates and
teaches nothing else, so calibration sees margins of texts that no other step has seen. The other parts teach
the beginnings and the trees, crosswise: a row that trains trees has its learned features from the beginnings
that the other parts taught, so they are as strong as on new texts. All texts are
scored with the beginnings that parts 1 to ``FOLDS`` taught together.

Features come from whole texts. The sample has at most ``TRAIN_ROWS`` rows of each class, chosen by
a hash of the id; what is learned from it is broadcast, and every text is scored in one pass.

Defined results: null, empty and blank texts have all features 0 and are scored like any other.
Rows without an id are scored and never held out. Repeated rows get equal scores. An empty
table gives an empty result; without labels of both classes the score is the share of label
1 (0 without any). Other columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, documents, map_text
from strata.llm.labelled import train_sample, verdict

PARTS, HELD = 4, 2
THRESHOLD = 0.3
TRAIN_ROWS = 10_000              # of each class, at most
LEARNED = 4000                   # learned word beginnings, at most: those of the highest ratio
STEMS = (4, 5, 6)                # letters of a beginning; whole words count as well
CERTAIN, LIFT = 24.0, 8.0        # least log-likelihood ratio and least lift of a beginning
KNOWN_WORDS = 300_000            # words whose verdict a task keeps before it starts afresh
NEAR = 8                         # words between an insult and a second person
TREES, DEPTH, SHRINK, BINS, LEAF = 60, 3, 0.2, 32, 8.0
FOLDS = 3                        # parts of the sample that teach; one more of equal size calibrates

#: Common insults, plainly and by language.
LEXICON = frozenset("""
arsehole asshole bastard bitch brainless clown coward creep cretin degenerate despicable dickhead
dimwit disgrace disgusting dumb dumbass dunce filth filthy fool freak garbage halfwit hideous idiot
idiotic idiots imbecile jackass jerk liar loser losers lowlife maggot moron moronic morons nitwit
parasite pathetic pervert psycho repulsive retard retarded scum scumbag shithead sicko slimeball
slut stupid swine thug traitor trash twat ugly useless vermin vile wanker weakling whore worthless
wretch
idiota estúpido estúpida basura asqueroso inútil payaso
idiote stupide crétin ordure connard salaud minable
dummkopf trottel schwachkopf abschaum wertlos widerlich versager
""".split())
#: Second-person words.
SECOND = frozenset("you your yours yourself u ur tu te toi vous votre usted ustedes du dich dir dein deine ihr".split())
#: Signs that stand for letters.
LEET = str.maketrans("013457@$", "oieastas")

FEATURES = ("learned", "learned_log", "lexicon", "lexicon_log", "near_second", "second", "hidden", "hidden_log", "capitals",
            "capital_words", "exclamation", "punctuation", "mixed", "log_words")
_PUNCT = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_TO_SPACE = bytes(32 if b in _PUNCT else b for b in range(256))
_SIGNS = b"0123456789@$*"
# looked for at the beginning of a run of these characters only, never from within one
_MIXED = re.compile(r"(?<![a-z013457@$*])\**+(?:[a-z]++[013457@$*]|[013457@$]++[a-z*])[a-z013457@$*]*+")
_APART = re.compile(r"(?<![^\s])(?:[a-z][ .\-_]){3,}[a-z](?![^\s.,!?;:])")
_BY_LENGTH: dict[int, list[str]] = {}
for _w in sorted(LEXICON):
    _BY_LENGTH.setdefault(len(_w), []).append(_w)


def hidden_insults(text: str) -> tuple[int, int]:
    """(insults behind signs, masks or gaps; words that mix letters and signs) of a lower-case text."""
    hits = mixed = 0
    for w in _MIXED.findall(text):
        w = w.lstrip("*")
        mixed += 1
        if "*" in w:
            plain = w.translate(LEET)
            hits += any(all(a in ("*", b) for a, b in zip(plain, x)) for x in _BY_LENGTH.get(len(w), ()))
        else:
            hits += w.translate(LEET) in LEXICON
    for w in _APART.findall(text):
        hits += re.sub(r"[ .\-_]", "", w) in LEXICON
    return hits, mixed


_WORD = re.compile(r"[^\W_]+")
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))


class Marks(dict):
    """word -> bits: 1 learned, 2 insult of the lexicon, 4 second person."""

    def __init__(self, learned=()):
        self.learned = frozenset(learned)

    def __missing__(self, w):
        learned = f"={w}" in self.learned or any(w[:k] in self.learned for k in STEMS if len(w) >= k)
        self[w] = mark = learned + 2 * (w in LEXICON) + 4 * (w in SECOND)
        return mark


def features(raw: bytes | None, marks: Marks) -> tuple[float, ...]:
    """The dense features of a whole text, in the order of FEATURES."""
    b = raw or b""
    text = b.decode("utf-8", "replace").lower()
    marked = np.array([marks[w] for w in _WORD.findall(text)], np.uint8)
    n = len(marked)
    if not n:
        return (0.0,) * len(FEATURES)
    learned, lexicon = int((marked & 1).sum()), int((marked & 2).sum()) // 2
    at, second, near = np.flatnonzero(marked & 3), np.flatnonzero(marked & 4), 0
    if len(at) and len(second):
        k = np.searchsorted(second, at)
        gap = np.minimum(np.abs(second[np.minimum(k, len(second) - 1)] - at), np.abs(second[np.maximum(k - 1, 0)] - at))
        near = int((gap <= NEAR).sum())
    hidden = mixed = 0
    if len(b.translate(None, _SIGNS)) < len(b) or _APART.search(text):
        hidden, mixed = hidden_insults(text)
    letters = len(b) - len(b.translate(None, _LETTERS))
    capitals = len(b) - len(b.translate(None, _CAPITALS))
    caps = sum(1 for w in b.split() if len(w) > 2 and w.isupper()) if capitals else 0
    size = len(b)
    return (learned / n, math.log1p(learned), lexicon / n, math.log1p(lexicon), near / n, len(second) / n,
            hidden / n, math.log1p(hidden), capitals / max(letters, 1), caps / n, b.count(b"!") / size,
            (size - len(b.translate(None, _PUNCT))) / size, mixed / n, math.log1p(n))


def part_of(doc_id: Column) -> Column:
    """The part of the sample, 0 to FOLDS, that a row belongs to: by a hash of its id (not the one that picks the sample)."""
    return F.pmod(F.xxhash64(F.lit("part"), doc_id), F.lit(FOLDS + 1)).cast("int")


def beginning_counts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(part, stem, a, b): toxic and other documents of each part with a word of that beginning (whole words as ``=word``)."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]++"))
    rows = (docs.where("text is not null").join(F.broadcast(chosen.where("part > 0")), "doc_id")     # at most 2 * TRAIN_ROWS
            .select("part", "y", words.alias("words")))
    cut = lambda k: F.transform(F.filter("words", lambda w: F.length(w) >= k),
                                lambda w: F.substring(w, F.lit(1), F.lit(k)))
    whole = F.transform(F.filter("words", lambda w: F.length(w) >= 3), lambda w: F.concat(F.lit("="), w))
    keys = F.array_distinct(F.concat(*[cut(k) for k in STEMS], whole))
    return (rows.select("part", "y", F.explode(keys).alias("stem")).groupBy("part", "stem")
            .agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")))


def learned_beginnings(counts: DataFrame, chosen: DataFrame, without: int = 0) -> list[str]:
    """Beginnings that mark toxic documents among the parts that teach, but for the part ``without``."""
    use = (F.col("part") > 0) & (F.col("part") != without)
    size = chosen.where(use).agg(F.coalesce(F.sum("y"), F.lit(0)).alias("n1"), F.count("*").alias("n")).first()
    n1, n0 = size.n1, size.n - size.n1
    if not n1 or not n0:
        return []
    found = counts.where(use).groupBy("stem").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    a, b, share = F.col("a"), F.col("b"), n1 / (n1 + n0)
    term = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    ratio = 2 * (term(a, (a + b) * share) + term(b, (a + b) * (1 - share)))
    lift = ((a + 0.5) / (n1 + 1)) / ((b + 0.5) / (n0 + 1))
    return [r.stem for r in found.withColumn("g", ratio).where((F.col("g") >= CERTAIN) & (lift >= LIFT))
            .orderBy(F.desc("g"), "stem").limit(LEARNED).select("stem").collect()]


# ---------------------------------------------------------------- trees and calibration

class Trees:
    """Gradient-boosted regression trees on the logistic loss, over quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
        # a rare feature is 0 almost everywhere: the edge of its zeros is a cut as well
        self.cuts = [np.unique(np.concatenate((c, [0.0]))) for c in self.cuts]
        bins = self.binned(x)
        share = min(max(y.mean(), 1e-6), 1 - 1e-6)
        self.base = math.log(share / (1 - share))
        self.trees: list[list[tuple]] = []
        margin = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            tree, leaf = self._grow(bins, p - y, p * (1 - p))
            self.trees.append(tree)
            margin += leaf

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)])

    def _grow(self, bins, g, h):
        """Nodes (feature, bin, left, right) or (None, value), and the value of every row."""
        nodes, out = [], np.zeros(len(g))

        def grow(rows, depth):
            here = len(nodes)
            nodes.append(None)
            G, H = g[rows].sum(), h[rows].sum()
            best = (1e-6, None, None)
            if depth < DEPTH and len(rows) >= 2 * LEAF:
                for f in range(bins.shape[1]):
                    b, k = bins[rows, f], len(self.cuts[f]) + 1
                    cg = np.cumsum(np.bincount(b, g[rows], k))[:-1]
                    ch = np.cumsum(np.bincount(b, h[rows], k))[:-1]
                    cn = np.cumsum(np.bincount(b, minlength=k))[:-1]
                    ok = (cn >= LEAF) & (len(rows) - cn >= LEAF)
                    gain = np.where(ok, cg ** 2 / (ch + 1) + (G - cg) ** 2 / (H - ch + 1) - G ** 2 / (H + 1), 0)
                    if len(gain) and gain.max() > best[0]:
                        best = (gain.max(), f, int(gain.argmax()))
            if best[1] is None:
                value = -SHRINK * G / (H + 1)
                out[rows] = value
                nodes[here] = (None, value)
            else:
                left = bins[rows, best[1]] <= best[2]
                a, b = grow(rows[left], depth + 1), grow(rows[~left], depth + 1)
                nodes[here] = (best[1], best[2], a, b)
            return here

        grow(np.arange(len(g)), 0)
        return nodes, out

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins, out = self.binned(x), np.full(len(x), self.base)
        for tree in self.trees:
            stack = [(0, np.arange(len(x)))]
            while stack:
                k, rows = stack.pop()
                node = tree[k]
                if node[0] is None:
                    out[rows] += node[1]
                elif len(rows):
                    left = bins[rows, node[0]] <= node[1]
                    stack += [(node[2], rows[left]), (node[3], rows[~left])]
        return out


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the monotone fit of y on the margin (pool adjacent violators)."""
    order = np.argsort(margin, kind="stable")
    xs, at = np.unique(margin[order], return_index=True)
    sums, sizes = np.add.reduceat(y[order].astype(float), at), np.diff(np.append(at, len(y)))
    pools: list[list[float]] = []                    # value, weight, number of margins
    for s, n in zip(sums, sizes):
        pools.append([s / n, n, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, n2, k = pools.pop()
            u, n1, j = pools.pop()
            pools.append([(u * n1 + v * n2) / (n1 + n2), n1 + n2, j + k])
    return xs, np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


class Model:
    def __init__(self, x: np.ndarray, y: np.ndarray, apart: np.ndarray):
        """``apart``: rows that calibrate (the others train)."""
        self.trees, self.share = None, float(y.mean()) if len(y) else 0.0
        if not 0 < self.share < 1:
            return
        both = lambda m: m.any() and 0 < y[m].mean() < 1
        if not (both(apart) and both(~apart)):
            apart = np.zeros(len(y), bool)               # too few rows to set some apart
        self.trees = Trees(x[~apart], y[~apart])
        use = apart if apart.any() else ~apart
        self.x, self.y = isotonic(self.trees.margin(x[use]), y[use])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.full(len(x), self.share)
        return np.clip(np.interp(self.trees.margin(x), self.x, self.y), 0, 1)


# ---------------------------------------------------------------- the operator

def dense_features(docs: DataFrame, learned: dict[int, list[str]], text_col: str = "text", carry=("doc_id",),
                   part: str | None = None) -> DataFrame:
    """``carry`` and the features; the beginnings are those of the row's ``part`` (a column of ``carry``), or of 0."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)       # at most LEARNED words for each part

    def make():
        marks = {k: Marks(v) for k, v in shared.value.items()}

        def fn(texts, parts=None):
            rows = np.array([features(t, marks[k]) for t, k in zip(texts, parts or [0] * len(texts))],
                            float).reshape(-1, len(FEATURES))
            for m in marks.values():
                if len(m) > KNOWN_WORDS:
                    m.clear()
            return [pa.array(rows[:, i]) for i in range(len(FEATURES))]

        return fn

    return map_text(docs, text_col, carry, [T.StructField(f, T.DoubleType()) for f in FEATURES], make,
                    also=[part] if part else [])


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   scratch: Scratch | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted and the features for every row of ``docs``."""
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    scratch = scratch or Scratch(docs.sparkSession, "toxicity")
    chosen = scratch.table(train_sample(labels, "toxic", PARTS, HELD, TRAIN_ROWS)
                           .withColumn("part", part_of(F.col("doc_id"))), "chosen")     # at most 2 * TRAIN_ROWS narrow rows
    counts = scratch.table(beginning_counts(named, chosen), "counts")
    learned = {k: learned_beginnings(counts, chosen, without=k) for k in range(FOLDS + 1)}
    sample = dense_features(named.join(F.broadcast(chosen), "doc_id"), learned, carry=("doc_id", "y", "part"), part="part")
    rows = sample.orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(2 * TRAIN_ROWS).toPandas()
    x, y = rows[list(FEATURES)].to_numpy(float).reshape(-1, len(FEATURES)), rows["y"].to_numpy(float)
    shared = docs.sparkSession.sparkContext.broadcast(Model(x, y, (rows["part"] == 0).to_numpy(bool)))
    dense = dense_features(named, {0: learned[0]})

    def run(batches):
        model = shared.value
        for b in batches:
            x = np.column_stack([b.column(f).to_numpy() for f in FEATURES]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(x))], [*b.schema.names, "score"])

    scored = dense.mapInArrow(run, T.StructType([*dense.schema.fields, T.StructField("score", T.DoubleType())]))
    return scored.select(*verdict(F.col("doc_id"), F.col("score"), PARTS, HELD, THRESHOLD), *FEATURES)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")
