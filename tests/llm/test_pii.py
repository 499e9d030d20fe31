import hashlib
import random
import re

from pyspark.sql import functions as F

from strata.llm.pii import (GENERALISE, KINDS, REMOVE, SUPPORT, disclosures, find_personal_data, op9_pii,
                            sanitised, stage, with_base_spans)

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def valid(k, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in v.split(".")),
            "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15}[k]()


def brute(t):
    found = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(PATTERNS.items())
                   for m in re.finditer(p, t or "") if valid(k, m[0]))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in found)


def listing(r):
    return ",".join(f"{KINDS[x.k]}:{x.s}:{x.e}" for x in r._spans)


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9_pii(spark, sf).collect()
    assert len(rows) == len(text)
    for r in rows:
        base = brute(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == base.count(":") // 2


def test_random_strings_against_brute_force(spark):
    rnd = random.Random(11)
    bits = ["a", "B9", "@", ".", "-", "1", "25", "255", "256", "+", "(", ")", " ", "\n", "é", "4111 1111 1111 1111",
            "x.y@z-1.com", "+1 (212) 555-0100", "10.0.0.1", "_", "%", "0", "5500-0000-0000-0004"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40)))) for i in range(1500)]
    rows += [(9000, "1" * 5000), (9001, "a" * 5000 + "@"), (9002, "1 " * 3000), (9003, "+1" + "(" * 3000), (9004, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.k0: listing(r) for r in find_personal_data(df).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_disclosing_terms_go_and_others_stay(spark):
    rows = [(i, f"n{i} some words here ask Zorblax or x.y@z.com now and later, tail{i}. ZORBLAX far") for i in range(6)]
    rows += [(100 + i, f"plain text {i} some words here ask now and later or other tail") for i in range(400)]
    rows += [(700, "another 10.9.8.7 some words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in stage(spark, df, None).collect()}
    assert len(out) == len(rows)
    assert all("lax" not in out[i].lower() and "[EMAIL]" in out[i] and "some words here" in out[i] for i in range(6))
    assert all(out[i] == t for i, t in rows if 100 <= i < 700) and out[700] == "another [IP] some words here"


def test_terms_far_from_the_entity_and_short_ones_disclose_too(spark):
    filler = " ".join(["some plain words stand in between here"] * 8)
    rows = [(i, f"Dear Zorblax, {filler} x.y@z.com {filler} Qu 王芳") for i in range(4)]
    rows += [(100 + i, f"Dear reader, {filler} or other tail {i}") for i in range(400)]
    rows += [(700, f"Zorblax {filler} a@b.org"), (701, f"Vex {filler} c@d.org"), (702, f"Vex {filler} c@d.org")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in stage(spark, df, None).collect()}
    # Zorblax: log(407 * 4 / (4 * 5)) / log(407 / 4) = 0.952; two documents are too few to tell (SUPPORT)
    assert all(out[i] == f"Dear , {filler} [EMAIL] {filler}  " for i in range(4))
    assert out[700] == f"Zorblax {filler} [EMAIL]" and out[701] == f"Vex {filler} [EMAIL]"
    assert all(out[i] == t for i, t in rows if 100 <= i < 700)


def test_disclosing_terms_against_brute_force(spark):
    import math

    rnd = random.Random(5)
    names = [f"w{i}" for i in range(60)] + ["a", "é", "7"]
    mails = [f"m{i}@h{i % 3}.org" for i in range(8)]
    rows = [(i, " ".join(rnd.sample(names[:rnd.choice((8, 30, 63))], 6) + rnd.sample(mails, rnd.choice((0, 0, 1, 2)))
                         + names[50:50 + i % 2 * 13])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = [set(re.findall(r"[^\W_]+", t.lower())) for _, t in rows]
    holds = [set(re.findall(r"\S+@\S+", t)) for _, t in rows]
    want = set()
    for e in mails:
        with_e = [k for k in range(len(rows)) if e in holds[k]]
        for t in set().union(*(terms[k] for k in with_e)):
            c, n = sum(t in terms[k] for k in with_e), sum(t in x for x in terms)
            score = math.log(len(rows) * c / (len(with_e) * n)) / math.log(len(rows) / len(with_e))
            if c >= SUPPORT and score >= GENERALISE:
                want.add((f"0:{e}", t, 4 if score >= REMOVE else 5))
    marked = with_base_spans(df, "text").withColumn("_id", F.col("doc_id")).where(F.size("_spans") > 0)
    got = [tuple(r) for r in disclosures(df, marked, "text").collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_overlapping_spans_are_replaced_once(spark):
    df = spark.range(1).select(F.lit("ab0123456789yz").alias("t"), F.expr(
        "array(named_struct('s',2,'k',2,'e',8,'v',''), named_struct('s',4,'k',3,'e',6,'v',''), "
        "named_struct('s',6,'k',3,'e',12,'v',''))").alias("spans"))
    assert df.select(sanitised(F.col("t"), F.col("spans"))).first()[0] == "ab[CARD][PHONE]yz"


def test_edges(spark, edge_rows, no_rows):
    rows = find_personal_data(edge_rows, carry=("doc_id", "n_words")).collect()
    assert len(rows) == 10
    assert [listing(r) for r in rows if r.k0 == 9] == ["email:5:13,phone:17:34,ip:36:44"]
    assert find_personal_data(no_rows).collect() == []
    staged = stage(spark, edge_rows, None)
    assert staged.columns == edge_rows.columns and staged.count() == 10


def test_hot_entity_and_many_terms(spark):
    """One address in every text with many rare terms: only pairs that a document holds are looked at."""
    rnd = random.Random(5)
    rows = [(i, " ".join(f"w{rnd.randint(0, 120)}" for _ in range(20)) + " hot@x.org " + f"own{i // 4}") for i in range(400)]
    rows += [(1000 + i, " ".join(f"w{rnd.randint(0, 120)}" for _ in range(20))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in stage(spark, df, None).collect()}
    # own<n>: log(1000 * 4 / (400 * 4)) / log(1000 / 400) = 1; the others meet the address by chance
    assert all(out[i].endswith("[EMAIL] ") and "w" in out[i] for i in range(400))
    assert all(out[i] == t for i, t in rows if i >= 1000)


def test_text_of_many_spans_in_linear_steps(spark):
    one = "u{}@mail.example.org said 10.0.0.1 Zorb "
    text = "".join(one.format(i) for i in range(6000))
    rows = [(i, text + f" é{i}") for i in range(4)] + [(10 + i, "other words") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.k0: r for r in find_personal_data(df).collect()}
    assert listing(got[0]) == brute(rows[0][1])
    assert sum(KINDS[x.k] == "removed" and x.v == "Zorb" for x in got[0].spans) == 6000
    out = {r.doc_id: r.text for r in stage(spark, df, None).collect()}
    assert out[10] == "other words" and out[0].count("[EMAIL]") == 6000 and "Zorb" not in out[0]


def test_running_and_cut(spark):
    from strata.llm.pii import CHUNK, cut, pieces, running
    n = 2 * CHUNK + 7
    df = spark.range(1).select(F.sequence(F.lit(1), F.lit(n)).cast("array<long>").alias("x"),
                               F.lit("añ\U0001F600" * CHUNK).alias("t"))
    sums = df.select(running(F.col("x"), lambda a, b: a + b)).first()[0]
    assert sums == [i * (i + 1) // 2 for i in range(1, n + 1)]
    back = df.select(running(F.reverse("x"), F.greatest), running(F.array().cast("array<long>"), F.greatest)).first()
    assert list(back[0]) == [n] * n and back[1] == []
    t = "añ\U0001F600" * CHUNK
    for s, e in [(0, 5), (CHUNK - 2, CHUNK + 2), (5, 3 * CHUNK), (7, 7), (CHUNK, 2 * CHUNK), (3 * CHUNK, 3 * CHUNK)]:
        assert df.select(cut(pieces(F.col("t")), F.lit(s), F.lit(e))).first()[0] == t[s:e]
