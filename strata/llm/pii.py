"""Personal data: patterns and information-theoretic sanitisation (operator 9).

Everything is DataFrame functions: no Python runs on the executors.

1. Base spans (email, ip, card, phone) come from regular expressions; offsets follow from the
   pieces between the matches.
2. The corpus tells how strongly a term reveals an entity. With N documents, n(e) that hold the
   entity, n(t) that hold the term and c(e, t) that hold both, wherever they stand, the disclosure
   of t for e is the pointwise mutual information as a share of the entity's information content:

       disclosure = log(N c(e,t) / (n(e) n(t))) / log(N / n(e))

   1 means that the term never occurs without the entity. A term is a run of letters and digits of
   any length. Terms with c(e, t) >= ``SUPPORT`` are removed from ``REMOVE`` up and generalised from
   ``GENERALISE`` up, wherever they occur in a document that holds the entity.

All counts cover all documents, whole. Pairs (entity, term) are made only for entities of at least
``SUPPORT`` documents (c(e, t) <= n(e), so no other pair can count), once per document; entities that
the same documents hold are one class.

Defined results: null and empty texts have no spans (the sanitised text stays null or empty).
Repeated rows count as documents of their own and get equal results; rows without an id as
well. An empty table gives an empty result. Other columns are ignored or, with ``carry``,
passed through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, bitmap, documents, maybe_in

#: Kinds in the order of the listing; sanitised terms come after the base kinds.
KINDS = ("email", "ip", "card", "phone", "removed", "general")
# A match starts where a run of its characters starts, or where the last match ended: the
# look-behinds spare the search every other start, the possessive quantifiers the way back.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])(?=(?:[ -]?[0-9]){14})[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$"
NO_TERM = r"[^\p{L}\p{N}]++"
SUPPORT = 3                     # documents in which term and entity meet
CHUNK = 1024                    # code points, or entries of an array, that are looked at together
MASK = "\uA74F"                 # a letter that stands for the characters of a span
PAIR_BITS = 1 << 24             # of the bitmap of disclosing pairs: 2 MB at most
GENERALISE, REMOVE = 0.75, 0.9


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also inside functions over arrays."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, op) -> Column:
    """Running results of the associative ``op`` over an array of numbers (longs), by chunks: appending
    to one long array would copy it once per entry."""
    def from_start(xs, start):
        # start is null before the first chunk
        first = F.struct(start.alias("acc"), F.expr("cast(array() as array<bigint>)").alias("out"))
        return F.aggregate(xs, first, lambda a, x: let(
            F.when(a["acc"].isNull(), x).otherwise(op(a["acc"], x)),
            lambda y: F.struct(y.alias("acc"), F.concat(a["out"], F.array(y)).alias("out"))), lambda a: a["out"])

    def chunked(xs):
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / CHUNK).cast("int")),
                             lambda c: F.slice(xs, c * CHUNK + 1, CHUNK))
        none = F.lit(None).cast("long")
        whole = lambda cs: from_start(F.transform(cs, lambda c: F.aggregate(
            F.slice(c, 2, CHUNK), F.get(c, F.lit(0)), lambda a, x: op(a, x))), none)
        return let(chunks, lambda cs: let(whole(cs), lambda upto: F.flatten(F.transform(
            cs, lambda c, i: from_start(c, F.when(i > 0, F.get(upto, i - 1)))))))

    return let(values, lambda xs: F.when(F.size(xs) > 0, chunked(xs)).otherwise(F.expr("cast(array() as array<bigint>)")))


def _fold(parts: Column, values: Column) -> Column:
    """Spans (s, e, v) of ``values`` that stand between the ``parts``."""
    def spans(ps, vs):
        sizes = F.transform(vs, lambda v, i: (F.length(F.get(ps, i)) + F.length(v)).cast("long"))
        return let(running(sizes, lambda a, x: a + x), lambda ends: F.transform(vs, lambda v, i: F.struct(
            (F.get(ends, i) - F.length(v)).cast("int").alias("s"), F.get(ends, i).cast("int").alias("e"), v.alias("v"))))

    return let(parts, lambda ps: let(values, lambda vs: spans(ps, vs)))


def _spans_type() -> Column:
    return F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)")


def matches(text: Column, pattern: Column) -> Column:
    """Leftmost non-overlapping matches as an array of (s, e, v): code points, end exclusive."""
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    return F.when(F.size(values) > 0, _fold(F.split(text, pattern, -1), values)).otherwise(_spans_type())


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(acc, i):
        d = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return v.rlike(IP_PARTS)
    if kind == "card":
        return F.length(_digits(v)).between(14, 19) & luhn(_digits(v))
    if kind == "phone":
        return F.length(_digits(v)).between(10, 15)
    return F.lit(True)


def with_base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``_spans``: array of (s, k, e, v), sorted; k numbers the kinds."""
    t = F.coalesce(F.col(text), F.lit(""))
    guard = {"email": F.contains(t, F.lit("@")), "phone": F.contains(t, F.lit("+"))}
    none = F.expr("cast(array() as array<string>)")
    kinds = KINDS[:4]
    for k in kinds:
        found = F.regexp_extract_all(t, F.lit(PATTERNS[k]), F.lit(0))
        df = df.withColumn(f"_v_{k}", F.when(guard[k], found).otherwise(none) if k in guard else found)
    def valid_spans(i, k):
        spans = F.when(F.size(f"_v_{k}") > 0, _fold(F.split(t, PATTERNS[k], -1), F.col(f"_v_{k}"))
                       ).otherwise(_spans_type())
        return F.transform(F.filter(spans, lambda x: _valid(k, x["v"])), lambda x: F.struct(
            x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e"), x["v"].alias("v")))

    parts = [valid_spans(i, k) for i, k in enumerate(kinds)]
    some = sum((F.size(f"_v_{k}") for k in kinds), F.lit(0)) > 0
    empty = F.expr("cast(array() as array<struct<s:int,k:int,e:int,v:string>>)")
    df = df.withColumn("_spans", F.when(some, F.array_sort(F.concat(*parts))).otherwise(empty))
    return df.drop(*[f"_v_{k}" for k in kinds])


def pieces(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut(chunks: Column, start: Column, end: Column) -> Column:
    """Code points start to end (exclusive) of a text in ``pieces``, looking only at those it lies in."""
    first = F.floor(start / CHUNK).cast("int")
    last = F.floor((end - 1) / CHUNK).cast("int")
    held = F.array_join(F.slice(chunks, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(held, (start % CHUNK + 1).cast("int"), (end - start).cast("int"))).otherwise("")


def replaced(text: Column, spans: Column, put) -> Column:
    """``text`` with each of the sorted spans replaced by ``put(span, end of those before)``; of
    overlapping spans the later ones only lose their rest."""
    def build(cs, xs, ends):
        before = lambda i: F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
        out = F.transform(xs, lambda x, i: F.when(x["e"] <= before(i), "").otherwise(
            F.concat(cut(cs, before(i), F.greatest(x["s"].cast("long"), before(i))), put(x, before(i)))))
        done = F.greatest(F.get(ends, F.size(ends) - 1), F.lit(0))
        return F.concat(F.array_join(out, ""), cut(cs, done, F.greatest(F.length(text).cast("long"), done)))

    ends = running(F.transform(spans, lambda x: x["e"].cast("long")), F.greatest)
    return F.when(F.size(spans) == 0, text).otherwise(
        let(pieces(text), lambda cs: let(spans, lambda xs: let(ends, lambda es: build(cs, xs, es)))))


def tokens_outside(text: Column, spans: Column) -> Column:
    """(s, e, v): the runs of letters and digits with their places; those that lie in spans are masked by ``MASK``."""
    masked = replaced(text, spans, lambda x, before: F.repeat(F.lit(MASK), (x["e"] - F.greatest(x["s"].cast("long"), before)).cast("int")))
    gaps = lambda t: F.concat(F.regexp_extract_all(t, F.lit(NO_TERM), F.lit(0)), F.array(F.lit("")))
    # a split text has one token more than gaps; each token stands before its gap
    def placed(ts, gs):
        sizes = F.transform(ts, lambda v, i: (F.length(v) + F.length(F.get(gs, i))).cast("long"))
        return let(running(sizes, lambda a, x: a + x), lambda ends: F.transform(ts, lambda v, i: F.struct(
            (F.get(ends, i) - F.length(F.get(gs, i)) - F.length(v)).cast("int").alias("s"),
            (F.get(ends, i) - F.length(F.get(gs, i))).cast("int").alias("e"), v.alias("v"))))

    return let(masked, lambda t: let(F.split(t, NO_TERM, -1), lambda ts: let(gaps(t), lambda gs: placed(ts, gs))))


def entities(marked: DataFrame) -> DataFrame:
    """(_id, entity) of the distinct entities of each row; an entity is kind number and value."""
    return (marked.select("_id", F.explode("_spans").alias("x"))
            .select("_id", F.concat_ws(":", F.col("x.k").cast("string"), F.lower("x.v")).alias("entity"))
            .distinct())


def term_list(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.filter(F.array_distinct(F.split(F.lower(text), NO_TERM)), lambda w: w != "")


def term_counts(docs: DataFrame, text: str) -> DataFrame:
    """(h, n): number of documents that hold the term of hash h, over all documents."""
    return (docs.where(F.col(text).isNotNull()).select(F.explode(term_list(F.col(text))).alias("term"))
            .groupBy(F.xxhash64("term").alias("h")).agg(F.count("*").alias("n")))


def entity_classes(marked: DataFrame) -> DataFrame:
    """(_id, entity, ne): the entities that at least SUPPORT documents hold, one for all that the same
    documents hold (they have equal counts with every term). A set of documents is known by its size and
    128 bits over its rows; so a list of thousands of addresses, copied as a whole, is one class."""
    found = entities(marked)
    rows = lambda seed: F.bit_xor(F.xxhash64("_id", F.lit(seed)))
    often = (found.groupBy("entity").agg(F.count("*").alias("ne"), rows(1).alias("a"), rows(2).alias("b"))
             .where(F.col("ne") >= SUPPORT))
    first = often.groupBy("ne", "a", "b").agg(F.min("entity").alias("entity"))
    return found.join(first, "entity").select("_id", "entity", "ne")


def held_pairs(marked: DataFrame, text: str) -> DataFrame:
    """(_id, entity, ne, term): every term of a document with each class of its entities."""
    held = entity_classes(marked).groupBy("_id").agg(F.collect_list(F.struct("entity", "ne")).alias("held"))
    return (marked.select("_id", text).join(held, "_id")
            .select("_id", "held", F.explode(term_list(F.col(text))).alias("term"))
            .select("_id", F.explode("held").alias("x"), "term").select("_id", "x.entity", "x.ne", "term"))


def entity_terms(marked: DataFrame, text: str) -> DataFrame:
    """(entity, ne, term, c) of the entity classes and terms that meet in at least SUPPORT documents."""
    return (held_pairs(marked, text).groupBy("entity", "ne", "term").agg(F.count("*").alias("c"))
            .where(F.col("c") >= SUPPORT))


def present_terms(marked: DataFrame, text: str, flags: DataFrame, scratch: Scratch) -> DataFrame:
    """(_id, term, level): the disclosing terms that a document holds. Only pairs that the document
    holds meet the flags, so the rows grow with the texts even if an entity is in most documents."""
    pair = F.xxhash64("entity", "term")
    told = scratch.table(bitmap(flags, pair, PAIR_BITS), "pairs-bitmap")
    return (maybe_in(held_pairs(marked, text), pair, told, PAIR_BITS).join(flags, ["entity", "term"])
            .groupBy("_id", "term").agg(F.min("level").alias("level")))


def term_spans(marked: DataFrame, text: str, present: DataFrame, scratch: Scratch) -> DataFrame:
    """(_id, more): the spans of the present terms, by one walk over the tokens of each text that has some."""
    parts = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.xxhash64("_id", "term")
    told = scratch.table(bitmap(present, key, PAIR_BITS), "terms-bitmap")
    # dealt by row, not by bytes: the work is in the walk over the tokens
    some = marked.repartition(parts, "_id").join(present.select("_id").distinct(), "_id", "left_semi")
    tokens = (some.select("_id", F.explode(tokens_outside(F.col(text), F.col("_spans"))).alias("x"))
              .select("_id", "x", F.lower("x.v").alias("term")))
    span = F.struct(F.col("x.s").alias("s"), F.col("level").alias("k"), F.col("x.e").alias("e"), F.col("x.v").alias("v"))
    return (maybe_in(tokens, key, told, PAIR_BITS).join(present, ["_id", "term"])
            .groupBy("_id").agg(F.collect_list(span).alias("more")))


def disclosures(docs: DataFrame, marked: DataFrame, text: str) -> DataFrame:
    """(entity, term, level) of the terms to remove (4) or generalise (5); an entity stands for its class."""
    total = docs.agg(F.count("*").alias("total"))
    joined = (entity_terms(marked, text).withColumn("h", F.xxhash64("term"))
              .join(term_counts(docs, text), "h").crossJoin(F.broadcast(total)))
    info = F.log(F.col("total") / F.col("ne"))
    score = F.when(info > 0, F.log(F.col("total") * F.col("c") / (F.col("ne") * F.col("n"))) / info)
    return (joined.withColumn("score", score).where(F.col("score") >= GENERALISE)
            .select("entity", "term", F.when(F.col("score") >= REMOVE, 4).otherwise(5).alias("level")))


def find_personal_data(docs: DataFrame, text_col: str = "text", carry=("doc_id",),
                       scratch: Scratch | None = None) -> DataFrame:
    """``carry`` columns under the names k0.., then ``t`` (the text), ``spans`` (s, k, e, v) of all
    kinds, sorted: base kinds and the terms that disclose the document's entities."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "pii")
    carry = list(carry)
    # the text is carried once, under one name, whether the caller asks for it or not
    at = f"k{carry.index(text_col)}" if text_col in carry else "t"
    src = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(carry)],
                      *([] if text_col in carry else [F.col(f"`{text_col}`").alias("t")]))
    plain = src.select(at)
    spans = with_base_spans(src, at)
    if at == "t":                   # only rows with spans need their text again
        spans = spans.withColumn("t", F.when(F.size("_spans") > 0, F.col("t")))
    found = scratch.table(spans.withColumn("_id", F.monotonically_increasing_id()), "base")
    some = found.where(F.size("_spans") > 0)
    marked = some.select("_id", at, "_spans")
    flags = scratch.table(disclosures(plain, marked, at), "flags")
    if flags.isEmpty():
        return found.withColumn("spans", F.col("_spans")).withColumn("t", F.col(at))
    present = scratch.table(present_terms(marked, at, flags, scratch), "present")
    more = term_spans(marked, at, present, scratch)
    full = some.join(more, "_id", "left").withColumn("spans", F.when(F.col("more").isNull(), F.col("_spans")).otherwise(
        F.array_sort(F.concat("_spans", "more")))).drop("more")
    rest = found.where(F.size("_spans") == 0).withColumn("spans", F.col("_spans"))
    out = full.unionByName(rest)
    return out if at == "t" else out.withColumn("t", F.col(at))


def _listing(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(kind, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir)).withColumnRenamed("k0", "doc_id")
    count = lambda i: F.size(F.filter("_spans", lambda x: x["k"] == i)).cast("long")
    n = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return found.select("doc_id", *n, F.sha2(_listing(F.col("_spans")), 256).alias("base_sha256"),
                        _listing(F.col("spans")).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """Base spans become ``[KIND]``, generalised terms ``[TERM]``, removed terms nothing."""
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS[:4]], F.lit(""), F.lit("[TERM]"))
    return F.when(F.size(spans) == 0, text).otherwise(replaced(text, spans, lambda x, _: F.get(marks, x["k"])))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sanitised: personal data masked, disclosing terms generalised or removed."""
    found = find_personal_data(docs, carry=docs.columns)
    clean = sanitised(F.col("t"), F.col("spans"))
    cols = []
    for i, c in enumerate(docs.columns):
        if c == "text":
            cols.append(clean.alias(c))
        elif c == "n_chars":
            cols.append(F.coalesce(F.length(clean), F.lit(0)).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(f"k{i}").alias(c))
    return found.select(*cols)
