"""Secret scans with one combined deterministic automaton (operator 7).

Rules are regular expressions over bytes (literals, classes, groups, ``|``, ``?``, ``*``,
``+``). They are compiled by subset construction and Moore minimisation into one transition
array over byte classes, in which every state says which rules are in a match; one pass
over the bytes then finds the matches of all rules.

* The subset of a rule is an ordered list of threads, oldest first, so matches are leftmost
  and longest; a thread that matches drops the younger ones, and where all threads die the
  rule starts afresh at that byte, so matches do not overlap.
* The pass is vectorised: the bytes of many texts are cut into pieces that advance side by
  side. A piece begins in the state in which the piece before it ends; pieces that began in
  another state are run again until all states agree, so the result is that of one long pass.
* The end of a match comes from the pass. Its start comes from the automaton of the reversed
  rule, run backwards from the first accepting byte of the match, which reads the match only.

A rule must end in a repeated class or in at least two fixed bytes, so that two matches never
touch. Offsets are code points, end exclusive.

Defined results: null and empty texts have no spans; repeated rows get equal results; an empty
table gives an empty result; other columns are ignored or, with ``carry``, passed through
whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.llm.common import documents, map_text

ANY_CASE = lambda w: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w)


@dataclass(frozen=True)
class Rule:
    """``tail``: the value, a repeated class that ends the match; it has ``least`` bytes or more
    (``least`` of 0: ``whole`` counts instead, the bytes of the whole match)."""

    kind: str
    head: str
    tail: str
    least: int = 0
    whole: int = 0


_KEYS = "|".join(ANY_CASE(w) for w in ("password", "passwd", "secret", "token")) + \
    "|" + ANY_CASE("api") + "_?" + ANY_CASE("key")
#: The base rules, then further well-known formats of credentials.
RULES = (
    Rule("assign", f"({_KEYS})[\"']? *[:=] *[\"']?", "[A-Za-z0-9+/_.=-]+", least=8),
    Rule("access", "AKIA", "[A-Z0-9]+", whole=16),
    Rule("hex", "", "[0-9a-f]+", whole=32),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY----", "-"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.]", "[A-Za-z0-9_-]+", whole=40),
    Rule("forge", "gh[oprsu]_", "[A-Za-z0-9]+", whole=40),
    Rule("chat", "xox[abprs]-", "[A-Za-z0-9-]+", whole=20),
    Rule("maps", "AIza", "[A-Za-z0-9_-]+", whole=39),
)
BASE = ("assign", "access", "hex")
PIECES = 2048                    # pieces that advance side by side

FIELDS = [T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
          T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()),
          T.StructField("spans", T.StringType())]


# ---------------------------------------------------------------- from rules to one automaton

class _Graph:
    """Thompson graph of one pattern: empty moves and byte moves."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[tuple[frozenset[int], int] | None] = []

    def node(self) -> int:
        self.empty.append([])
        self.moves.append(None)
        return len(self.empty) - 1

    def parse(self, p: str) -> tuple[int, int]:
        self.p, self.i = p, 0
        return self._either()

    def _peek(self):
        return self.p[self.i] if self.i < len(self.p) else ""

    def _either(self):
        a, b = self._sequence()
        while self._peek() == "|":
            self.i += 1
            c, d = self._sequence()
            s, e = self.node(), self.node()
            self.empty[s] += [a, c]
            self.empty[b].append(e)
            self.empty[d].append(e)
            a, b = s, e
        return a, b

    def _sequence(self):
        a = b = self.node()
        while self._peek() not in ("", "|", ")"):
            c, d = self._repeat()
            self.empty[b].append(c)
            b = d
        return a, b

    def _repeat(self):
        a, b = self._atom()
        while self._peek() in ("?", "*", "+") and self._peek():
            how = self._peek()
            self.i += 1
            s, e = self.node(), self.node()
            self.empty[s].append(a)
            self.empty[b].append(e)
            if how in "*+":
                self.empty[b].append(a)
            if how in "?*":
                self.empty[s].append(e)
            a, b = s, e
        return a, b

    def _atom(self):
        c = self.p[self.i]
        self.i += 1
        if c == "(":
            a, b = self._either()
            self.i += 1
            return a, b
        chars = {ord(c)}
        if c == "[":
            end = self.p.index("]", self.i + 1)
            body, chars, k = self.p[self.i:end], set(), 0
            while k < len(body):
                if k + 2 < len(body) and body[k + 1] == "-":
                    chars |= set(range(ord(body[k]), ord(body[k + 2]) + 1))
                    k += 3
                else:
                    chars.add(ord(body[k]))
                    k += 1
            self.i = end + 1
        a, b = self.node(), self.node()
        self.moves[a] = (frozenset(chars), b)
        return a, b

    def closure(self, nodes) -> tuple[int, ...]:
        """Nodes with a byte move, and the last node, that empty moves reach, in order."""
        out, seen, stack = [], set(), list(reversed(list(nodes)))
        while stack:
            n = stack.pop()
            if n in seen:
                continue
            seen.add(n)
            out.append(n)
            stack += reversed(self.empty[n])
        return tuple(n for n in out if self.moves[n] or n == self.last)


def _graph(pattern: str) -> tuple[_Graph, tuple[int, ...]]:
    g = _Graph()
    g.last = None
    first, g.last = g.parse(pattern)
    return g, g.closure([first])


def reversed_pattern(p: str) -> str:
    """The pattern of the reversed strings."""
    parts, i = [[]], 0
    while i < len(p):
        j = i + 1
        if p[i] == "[":
            j = p.index("]", i + 2) + 1
            item = p[i:j]
        elif p[i] == "(":
            depth = 1
            while depth:
                if p[j] == "[":
                    j = p.index("]", j + 2)
                depth += (p[j] == "(") - (p[j] == ")")
                j += 1
            item = f"({reversed_pattern(p[i + 1:j - 1])})"
        elif p[i] == "|":
            parts.append([])
            i = j
            continue
        else:
            item = p[i]
        while j < len(p) and p[j] in "?*+":
            item += p[j]
            j += 1
        parts[-1].append(item)
        i = j
    return "|".join("".join(reversed(x)) for x in parts)


class Automaton:
    """``table``: state * classes + class -> state; ``accept``: bit mask of rules per state."""

    def __init__(self, rules=RULES):
        self.rules = rules
        graphs = [_graph(f"({r.head}){r.tail}" if r.head else r.tail) for r in rules]
        sets = {frozenset(m[0]) for g, _ in graphs for m in g.moves if m}
        by_key: dict[tuple, int] = {}
        self.classes = np.empty(256, np.int64)
        reps = []
        for b in range(256):
            key = tuple(b in s for s in sorted(sets, key=sorted))
            if key not in by_key:
                by_key[key] = len(by_key)
                reps.append(b)
            self.classes[b] = by_key[key]
        self.n_classes = len(reps)

        # a state: for each rule the ordered threads that are alive (the start ones not among them)
        memo: dict[tuple, tuple] = {}

        def advance(k, threads, b):
            """Threads of rule k after byte b."""
            if (k, threads, b) in memo:
                return memo[k, threads, b]
            g, start = graphs[k]

            def go(nodes):
                out = []
                for n in nodes:
                    if g.moves[n] and b in g.moves[n][0]:
                        for x in g.closure([g.moves[n][1]]):
                            if x not in out:
                                out.append(x)
                return tuple(out)

            # after a match no younger thread starts, until the match has ended and the rule starts afresh
            running = g.last in threads and go(threads)
            new: tuple[int, ...] = ()
            for group in [(n,) for n in threads] + ([] if running else [start]):
                new += tuple(x for x in go(group) if x not in new)
                if g.last in new:                  # a match belongs to the oldest thread: the younger go
                    break
            memo[k, threads, b] = new
            return new

        first = tuple(() for _ in rules)
        number, queue, rows, accept = {first: 0}, [first], [], []
        while queue:
            state = queue.pop(0)
            accept.append(sum(1 << k for k, t in enumerate(state) if graphs[k][0].last in t))
            row = []
            for b in reps:
                new = tuple(advance(k, t, b) for k, t in enumerate(state))
                if new not in number:
                    number[new] = len(number)
                    queue.append(new)
                row.append(number[new])
            rows.append(row)
        self.table, self.accept = _minimised(np.array(rows), np.array(accept))
        self.back = [_Backward(r.head) if r.head else None for r in rules]

    def states(self, data: np.ndarray) -> np.ndarray:
        """State after every byte of ``data``, as one pass from the start state would give."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64)
        c = self.n_classes
        flat = (self.table * c).ravel().astype(np.int32)      # states premultiplied
        width = max(64, -(-n // PIECES))
        pieces = -(-n // width)
        cls = np.zeros(pieces * width, np.int32)
        cls[:n] = self.classes[data]
        cls = np.ascontiguousarray(cls.reshape(pieces, width).T)
        out = np.empty((width, pieces), np.int32)

        def run(which, begin):
            s, whole = begin, len(which) == pieces
            for t in range(width):
                s = flat[s + (cls[t] if whole else cls[t, which])]
                if whole:
                    out[t] = s
                else:
                    out[t, which] = s

        begun = np.zeros(pieces, np.int32)
        run(np.arange(pieces), begun)
        while True:
            due = np.concatenate((np.zeros(1, np.int32), out[-1, :-1]))
            wrong = np.flatnonzero(due != begun)
            if not len(wrong):
                break
            begun[wrong] = due[wrong]
            run(wrong, due[wrong])
        return out.T.reshape(-1)[:n] // c

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text the spans (start, end, rule) in bytes, sorted."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        # a byte that no rule has stands between texts and brings every rule back to its start
        data = b"\n".join(texts) + b"\n"
        at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        mask = self.accept[self.states(np.frombuffer(data, np.uint8))]
        for k, r in enumerate(self.rules):
            hit = np.flatnonzero(np.diff(np.concatenate(([0], (mask >> k) & 1, [0]))))
            a, b = hit[::2], hit[1::2]
            # a match has len(head) bytes more than the run of its tail; short runs are left out early
            if not r.head:
                ok = (b - a) >= max(r.least, r.whole)
                a, b = a[ok], b[ok]
            elif r.least:
                ok = (b - a) >= r.least
                a, b = a[ok], b[ok]
            for s, e in zip(a.tolist(), b.tolist()):
                begin = self.back[k].start(data, s) if r.head else s
                if e - begin >= r.whole:
                    i = int(np.searchsorted(at, s, side="right")) - 1
                    found[i].append((begin - int(at[i]), e - int(at[i]), k))
        for f in found:
            f.sort(key=lambda x: (x[0], x[2]))
        return found


def _minimised(table: np.ndarray, accept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moore's refinement: states stay together while all their moves lead to the same blocks."""
    block = np.unique(accept, return_inverse=True)[1]
    while True:
        new = np.unique(np.column_stack((block, block[table])), axis=0, return_inverse=True)[1].ravel()
        if new.max() == block.max():
            break
        block = new
    # number the blocks by their first state, so that the start state stays 0
    first = np.array([np.flatnonzero(block == k)[0] for k in range(block.max() + 1)])
    order = np.argsort(first)
    rank = np.empty(len(order), int)
    rank[order] = np.arange(len(order))
    firsts = first[order]
    return rank[block[table[firsts]]], accept[firsts]


class _Backward:
    """Automaton of the reversed head, run backwards from the first byte of a tail."""

    def __init__(self, head: str):
        self.g, self.first = _graph(reversed_pattern(head))
        self.memo: dict[tuple, tuple] = {}

    def start(self, data: bytes, end: int) -> int:
        threads, i, best = self.first, end, end
        while threads and i > 0:
            i -= 1
            key = (threads, data[i])
            if key not in self.memo:
                out: list[int] = []
                for n in threads:
                    if self.g.moves[n] and data[i] in self.g.moves[n][0]:
                        out += [x for x in self.g.closure([self.g.moves[n][1]]) if x not in out]
                self.memo[key] = tuple(out)
            threads = self.memo[key]
            if self.g.last in threads:
                best = i
        return best


# ---------------------------------------------------------------- the operator

def _batch_fn(machine):
    def fn(texts):
        texts = [t or b"" for t in texts]
        rows = []
        for t, found in zip(texts, machine.spans(texts)):
            lead = np.cumsum((np.frombuffer(t, np.uint8) & 0xC0) != 0x80) if found else None
            cp = lambda i: int(lead[i - 1]) if i else 0  # noqa: E731,B023
            names = [(RULES[k].kind, cp(s), cp(e)) for s, e, k in found]
            base = [x for x in names if x[0] in BASE]
            text = lambda xs: ",".join(f"{k}:{s}:{e}" for k, s, e in xs)
            rows.append((*[sum(x[0] == k for x in base) for k in BASE],
                         hashlib.sha256(text(base).encode()).hexdigest(), text(names)))
        cols = list(zip(*rows)) if rows else [()] * len(FIELDS)
        return [pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 3 + [pa.string()] * 2)]

    return fn


def scan(docs: DataFrame, text_col: str = "text", carry=("doc_id",)) -> DataFrame:
    """``carry`` columns, counts of the base kinds, digest of the base spans, and all spans."""
    # compiled once; the transition arrays have a fixed size (about a megabyte)
    shared = docs.sparkSession.sparkContext.broadcast(Automaton())
    return map_text(docs, text_col, carry, FIELDS, lambda: _batch_fn(shared.value))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
