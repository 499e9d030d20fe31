import hashlib
import random
import re

from strata.llm.secrets import ANY_CASE, Automaton, op7_secrets, reversed_pattern, scan

KEYS = "|".join(map(ANY_CASE, ("password", "passwd", "secret", "token"))) + "|" + ANY_CASE("api") + "_?" + ANY_CASE("key")
PATTERNS = [("assign", re.compile(r"(" + KEYS + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 8),
            ("access", re.compile(r"AKIA[A-Z0-9]+"), 16), ("hex", re.compile(r"[0-9a-f]+"), 32)]


def brute(t):
    found = sorted((m.start(), i, m.end(), k) for i, (k, p, n) in enumerate(PATTERNS) for m in p.finditer(t or "")
                   if len(m[2] if k == "assign" else m[0]) >= n)
    return [(k, s, e) for s, _, e, k in found]


def listed(xs):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in xs)


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op7_secrets(spark, sf).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = brute(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for k, _, _ in want) for x in ("assign", "access", "hex")]
        assert set(listed(want).split(",")) <= set(r.spans.split(","))


def test_random_strings_against_brute_force():
    rnd, machine = random.Random(5), Automaton()
    bits = ["token", "Secret", "password", "passwd", "API_KEY", "apikey", "=", ":", " ", "  ", '"', "'", "abcdef",
            "0123456789abcdef" * 2, "AKIA", "ABCDEFGHIJKLMNOP", "é", "\n", ",", "x", "-", "deadbeef" * 5, ".", "K"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 60))) for _ in range(6000)]
    for t, found in zip(texts, machine.spans([t.encode() for t in texts])):
        b = t.encode()
        got = [("assign access hex".split()[k], len(b[:s].decode()), len(b[:e].decode())) for s, e, k in found if k < 3]
        assert got == brute(t)


def test_further_rules_and_long_pieces():
    machine = Automaton()
    jwt = b"eyJhbGciOi.eyJzdWIiOiIxMjM0NTY3ODkw.SflKxwRJSMeKKF2QT4"
    text = b"-----BEGIN RSA PRIVATE KEY----- " + jwt + b" ghp_" + b"a" * 36 + b" " + b"f" * 100_000
    kinds = [machine.rules[k].kind for _, _, k in machine.spans([text])[0]]
    assert kinds == ["pem", "jwt", "forge", "hex", "hex"]
    assert machine.spans([b"AKIA" + b"A" * 9000, b"", b"token=" + b"z" * 9000]) == [[(0, 9004, 1)], [], [(0, 9006, 0)]]


def test_reversed_pattern():
    assert reversed_pattern("(ab|c[de]+)f? *") == " *f?(ba|[de]+c)"


def test_edges(edge_rows, no_rows):
    rows = scan(edge_rows, carry=("doc_id", "n_words")).collect()
    assert len(rows) == 10 and all(r.spans == "" for r in rows)
    assert scan(no_rows).collect() == []
