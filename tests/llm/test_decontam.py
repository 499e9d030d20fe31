import hashlib
import random
import re

from strata.llm import decontam
from strata.llm.decontam import decontaminate, op1_decontam, stage


def split(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = split(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    sizes = {len(x) for x in wins}
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                got = wins.get(tuple(w[k:k + n]))
                if got:
                    found |= got
                    hit |= set(range(k, k + n))
        ids = sorted(found)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


def test_whole_tables_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    read = lambda n, *c: [tuple(r) for r in spark.read.parquet(f"{sf}/{n}.parquet").select(*c).collect()]
    want = brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    assert any(r[2] for r in want)
    assert got(op1_decontam(spark, sf)) == want


def test_random_against_brute_force_in_blocks(spark, monkeypatch):
    rnd = random.Random(7)
    seps = [" ", ", ", "\n", "-", "\x7f", "__", ". "]
    word = lambda: rnd.choice(["a", "B", "ab", "É", "ß1", "9", "Z"])
    text = lambda n: "".join(word() + rnd.choice(seps) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 3, 12, 13, 14, 20]))) for i in range(25)] + [(99, None), (3, "q q q q")]
    docs = [(i, text(rnd.randint(0, 60)) + (rnd.choice(items)[1] or "") if rnd.random() < 0.7 else text(30))
            for i in range(150)]
    docs += [(500, None), (501, ""), (502, " .\n")]
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert got(decontaminate(a, b)) == want
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 2000)      # several automata
    assert got(decontaminate(a, b)) == want


def test_spans_lead_to_the_original(spark):
    passage = "Él VIÓ, one--two three four five six seven eight nine ten eleven twelve 13"
    df = spark.createDataFrame([(1, "ñ start. " + passage + ". end")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, passage)], "item_id long, text string")
    r = decontaminate(df, bench).first()
    (a, b), = r.spans
    assert df.first().text[a:b] == passage and r.item_ids == ["5"]


def test_edges(spark, edge_rows, no_rows):
    bench = spark.createDataFrame([(1, "one two"), (None, "one two"), (2, None)], "item_id long, text string")
    rows = decontaminate(edge_rows, bench, carry=("doc_id", "n_words")).collect()
    assert len(rows) == 10 and [r[3] for r in rows if r[0] == 4] == [2, 2]
    assert [r.n_items for r in rows if r[0] == 4] == [1, 1]
    assert decontaminate(no_rows, bench).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate(edge_rows, none).collect())
    assert stage(spark, edge_rows, "/root/testdata/sf0.001").columns == edge_rows.columns
