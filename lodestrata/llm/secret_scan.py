"""Secret scanning with one minimal deterministic automaton for all rules.

Each rule is a small regular expression over bytes.  Its positions (Glushkov) and those of the other rules are joined,
subset construction gives one deterministic automaton, and partition refinement makes it minimal.  Its transitions lie in
one array over byte classes.  A scan reads each byte of a batch once: the batch is cut into lanes that step together, and
a lane that began in the wrong state is stepped again until it meets the states it had.  Texts with a hit are scanned
likewise by the hit rule's own automaton, whose first state parts them into stretches that no match crosses.  Only
stretches with a hit are cut into exact spans, byte by byte.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import blobs, small_batches, steps

SEPARATOR = 255  # no byte of UTF-8


@dataclass(frozen=True)
class Rule:
    """Spans are the leftmost longest matches of ``pattern`` that don't overlap; those that don't match ``need`` whole are dropped.

    The joint automaton looks for ``cue``, which every match of ``need`` contains.  Counted repeats of several rules would
    multiply its states, so rules with a telling prefix have that as their cue.
    """

    kind: str
    pattern: str
    need: str
    cue: str
    any_case: bool = False


#: The three base rules, in this order.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}""",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""",
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]{16}"),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
)
#: Publicly documented token formats that the scan reports besides (kind, pattern, cue).
MORE = tuple(
    Rule(kind, pattern, pattern, cue)
    for kind, pattern, cue in (
        ("github", r"gh[pousr]_[A-Za-z0-9]{20,}", r"gh[pousr]_[A-Za-z0-9]"),
        ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", r"xox[abprs]-[A-Za-z0-9]"),
        ("google", r"AIza[A-Za-z0-9_-]{30,}", r"AIza"),
        ("payment", r"[rs]k_(live|test)_[A-Za-z0-9]{16,}", r"[rs]k_(live|test)_"),
        ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ[A-Za-z0-9_-]"),
        ("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", r"-----BEGIN "),
    )
)


class Positions:
    """A regular expression as positions: which bytes each takes, where it may begin, end and go on."""

    def __init__(self):
        self.takes: list[frozenset[int]] = []
        self.follow: list[set[int]] = []

    def atom(self, chars: frozenset[int]):
        self.takes.append(chars)
        self.follow.append(set())
        at = {len(self.takes) - 1}
        return at, at, False  # first, last, may be empty

    def then(self, a, b):
        for p in a[1]:
            self.follow[p] |= b[0]
        return a[0] | (b[0] if a[2] else set()), b[1] | (a[1] if b[2] else set()), a[2] and b[2]

    def either(self, a, b):
        return a[0] | b[0], a[1] | b[1], a[2] or b[2]

    def loop(self, a):
        for p in a[1]:
            self.follow[p] |= a[0]
        return a

    def parse(self, pattern: str, any_case: bool):
        """Literals, [classes], \\xHH and escaped characters, groups, |, and the repeats ? * + {m} {m,} {m,n}."""
        at, nothing = 0, (set(), set(), True)

        def char() -> str:
            nonlocal at
            at += 1
            if pattern[at - 1] != "\\":
                return pattern[at - 1]
            at += 1
            if pattern[at - 1] == "x":
                at += 2
                return chr(int(pattern[at - 2 : at], 16))
            return pattern[at - 1]

        def cased(chars: set[int]) -> frozenset[int]:
            return frozenset(y for x in chars for y in ((ord(chr(x).lower()), ord(chr(x).upper())) if any_case and chr(x).isalpha() else (x,)))

        def bracket() -> frozenset[int]:
            nonlocal at
            chars: set[int] = set()
            while pattern[at] != "]":
                low = char()
                if pattern[at] == "-" and pattern[at + 1] != "]":
                    at += 1
                    chars |= set(range(ord(low), ord(char()) + 1))
                else:
                    chars.add(ord(low))
            at += 1
            return cased(chars)

        def one():
            nonlocal at
            begin = at
            if pattern[at] == "(":
                at += 1
                out = choice()
                at += 1
            elif pattern[at] == "[":
                at += 1
                out = self.atom(bracket())
            else:
                out = self.atom(cased({ord(char())}))
            while at < len(pattern) and pattern[at] in "?*+{":
                end = at
                if pattern[at] == "{":
                    close = pattern.index("}", at)
                    low, _, high = pattern[at + 1 : close].partition(",")
                    least, most = int(low), int(high) if high else None if "," in pattern[at:close] else int(low)
                    at = close + 1
                else:
                    least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[pattern[at]]
                    at += 1
                after, parts = at, [out]
                for _ in range(max(least, most or 0, 1) - 1):  # more copies of what is repeated
                    at = begin
                    parts.append(atom_only(end))
                at = after
                out = nothing
                for i, part in enumerate(parts):
                    part = self.loop(part) if most is None and i == len(parts) - 1 else part
                    out = self.then(out, part if i < least else (part[0], part[1], True))
            return out

        def atom_only(end: int):
            nonlocal at
            if pattern[at] == "(":
                at += 1
                out = choice()
                at += 1
            elif pattern[at] == "[":
                at += 1
                out = self.atom(bracket())
            else:
                out = self.atom(cased({ord(char())}))
            assert at == end, "only one repeat may follow an item"
            return out

        def sequence():
            out = nothing
            while at < len(pattern) and pattern[at] not in "|)":
                out = self.then(out, one())
            return out

        def choice():
            nonlocal at
            out = sequence()
            while at < len(pattern) and pattern[at] == "|":
                at += 1
                out = self.either(out, sequence())
            return out

        return choice()


@dataclass(frozen=True)
class Automaton:
    """``step[state + byte_class]`` is the next state; states are multiples of the number of classes, 0 the first.

    ``accepts[state // classes]`` has bit r set if rule r accepts there; accepting states are the last ones, from ``accepting`` on.
    """

    class_of: np.ndarray
    step: np.ndarray
    accepts: np.ndarray
    accepting: int
    classes: int
    dead: int


def compile_rules(patterns: list[tuple[str, bool]], anywhere: bool, backward: bool = False) -> Automaton:
    """Subset construction and minimisation; ``anywhere``: matches may begin at every byte."""
    nfa = Positions()
    starts, ends = 0, []
    for pattern, any_case in patterns:
        first, last, empty = nfa.parse(pattern, any_case)
        assert not empty, "a rule must not match nothing"
        ends.append(first if backward else last)
        starts |= sum(1 << p for p in (last if backward else first))
    follow = [0] * len(nfa.takes)
    for p, nexts in enumerate(nfa.follow):
        for q in nexts:
            if backward:
                follow[q] |= 1 << p
            else:
                follow[p] |= 1 << q
    for r, last in enumerate(ends):  # one bit above the positions for each rule that has matched
        for p in last:
            follow[p] |= 1 << (len(nfa.takes) + r)
    # bytes that all positions treat alike are one class
    kinds: dict[tuple, int] = {}
    class_of = np.zeros(256, np.uint8)
    for b in range(256):
        class_of[b] = kinds.setdefault(tuple(p for p, chars in enumerate(nfa.takes) if b in chars and b != SEPARATOR), len(kinds))
    takers = [sum(1 << p for p in kind) for kind in kinds]
    body = (1 << len(nfa.takes)) - 1
    number, queue, table = {starts: 0}, [starts], []
    for state in queue:
        row = []
        for takes in takers:
            live, nexts = state & takes & body, starts if anywhere else 0
            while live:
                low = live & -live
                nexts |= follow[low.bit_length() - 1]
                live ^= low
            if nexts not in number:
                number[nexts] = len(queue)
                queue.append(nexts)
            row.append(number[nexts])
        table.append(row)
    step = np.array(table)
    accepts = np.array([state >> len(nfa.takes) for state in queue], np.int64)
    # Refine the partition by acceptance until no two states of one part lead to different parts.
    part = np.unique(accepts, return_inverse=True)[1]
    while True:
        new = np.unique(np.column_stack([part, part[step]]), axis=0, return_inverse=True)[1].ravel()
        if new.max() == part.max():
            break
        part = new
    member = np.zeros(part.max() + 1, np.int64)
    member[part[::-1]] = np.arange(len(part))[::-1]  # the first state of each part
    order = sorted(range(len(member)), key=lambda k: (accepts[member[k]] != 0, member[k]))
    rank = np.empty(len(member), np.int64)
    rank[order] = np.arange(len(member))
    rows = member[order]
    step, accepts = rank[part[step[rows]]], accepts[rows]
    assert rank[part[0]] == 0
    stuck = [i for i in range(len(step)) if not accepts[i] and (step[i] == i).all()]
    width = len(takers)
    return Automaton(class_of, (step * width).ravel().astype(np.int64), accepts, int((accepts == 0).sum()) * width, width, stuck[0] * width if stuck else -1)


@dataclass(frozen=True)
class Scanner:
    rules: tuple[Rule, ...]
    together: Automaton
    alone: tuple[Automaton, ...]
    backward: tuple[Automaton, ...]
    longest: tuple[Automaton, ...]
    needed: tuple[Automaton, ...]


def loose(pattern: str) -> str:
    """A pattern that may go on wherever ``pattern`` may, without the states that count repeats."""
    return re.sub(r"\{[0-9]+,\}", "+", pattern)


@lru_cache(4)
def scanner(rules: tuple[Rule, ...] = BASE + MORE) -> Scanner:
    each = lambda of, **how: tuple(compile_rules([(of(r), r.any_case)], **how) for r in rules)
    return Scanner(rules, compile_rules([(r.cue, r.any_case) for r in rules], anywhere=True), each(lambda r: loose(r.pattern), anywhere=True), each(lambda r: r.pattern, anywhere=True, backward=True), each(lambda r: r.pattern, anywhere=False), each(lambda r: r.need, anywhere=False))


def states_of(buffer: np.ndarray, dfa: Automaton) -> np.ndarray:
    """The state after each byte of ``buffer``, which begins in state 0 and may be followed by some more."""
    lanes = max(1, min(4096, len(buffer) // 256))
    length = -(-len(buffer) // lanes)
    classes = np.full(lanes * length, dfa.class_of[SEPARATOR], np.uint8)
    classes[: len(buffer)] = dfa.class_of[buffer]
    columns = np.ascontiguousarray(classes.reshape(lanes, length).T)
    states = np.empty((length, lanes), np.int32)
    now = np.zeros(lanes, np.int64)
    for j in range(length):
        now = dfa.step[now + columns[j]]
        states[j] = now
    # Lanes whose predecessor ended elsewhere than in state 0 are stepped again, until nothing changes.
    todo = np.arange(1, lanes)
    entered = np.zeros(lanes, np.int64)
    while len(todo):
        todo = todo[states[-1, todo - 1] != entered[todo]]
        live, now = todo, states[-1, todo - 1].astype(np.int64)
        entered[todo] = now
        for j in range(length):
            if not len(live):
                break
            now = dfa.step[now + columns[j, live]]
            differ = now != states[j, live]
            live, now = live[differ], now[differ]
            states[j, live] = now
        todo = live[live < lanes - 1] + 1
    return states.T.ravel()


def scan(buffer: np.ndarray, dfa: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Where the automaton accepts and which rules, from one pass over ``buffer``."""
    flat = states_of(buffer, dfa)
    hit = np.flatnonzero(flat >= dfa.accepting)
    return hit, dfa.accepts[flat[hit] // dfa.classes]


def stretches(buffer: np.ndarray, dfa: Automaton, hits: np.ndarray) -> list[tuple[int, int]]:
    """Runs of bytes behind which a match may still go on, if one of ``hits`` (ascending) is in them: no match crosses their ends."""
    open_ = np.concatenate([[False], states_of(buffer, dfa)[: len(buffer)] != 0, [False]])
    edge = np.flatnonzero(open_[1:] != open_[:-1])
    begins, ends = edge[::2], edge[1::2]
    some = np.searchsorted(hits, begins) < np.searchsorted(hits, ends)
    return list(zip(begins[some].tolist(), ends[some].tolist(), strict=True))


def spans_of(text: bytes, rule: int, machine: Scanner) -> list[tuple[int, int]]:
    """Byte spans of one rule in a text, or in a stretch of one that no match crosses."""
    back, ahead, need = machine.backward[rule], machine.longest[rule], machine.needed[rule]
    state, begins = 0, []
    step, accepting = back.step, back.accepting
    for i, c in enumerate(back.class_of[np.frombuffer(text, np.uint8)[::-1]].tolist()):
        state = int(step[state + c])
        if state >= accepting:
            begins.append(len(text) - 1 - i)
    forward = ahead.class_of[np.frombuffer(text, np.uint8)].tolist()
    out, free = [], 0
    for begin in reversed(begins):
        if begin < free:
            continue
        state, end = 0, begin
        for i in range(begin, len(text)):
            state = int(ahead.step[state + forward[i]])
            if state >= ahead.accepting:
                end = i + 1
            elif state == ahead.dead:
                break
        if end > begin:
            free, state = end, 0
            for c in need.class_of[np.frombuffer(text[begin:end], np.uint8)].tolist():
                state = int(need.step[state + c])
            if state >= need.accepting:
                out.append((begin, end))
    return out


def find_secrets(parts: list[bytes], machine: Scanner) -> list[list[tuple[int, int, int]]]:
    """(start, rule, end) of each text in code points, by start and then rule."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in parts]
    for lo, hi in steps([len(p) for p in parts]):
        own = parts[lo:hi]
        buffer = np.frombuffer(bytes([SEPARATOR]).join([*own, b""]), np.uint8)
        if not len(buffer):
            continue
        ends = np.cumsum([len(p) + 1 for p in own])
        where, which = scan(buffer, machine.together)
        if not len(where):
            continue
        found: dict[int, list[tuple[int, int, int]]] = {}
        doc = np.searchsorted(ends, where, side="right")
        begins = ends - np.array([len(p) + 1 for p in own])
        for r in range(len(machine.rules)):
            of = which >> r & 1 == 1
            if not of.any():
                continue
            docs = np.unique(doc[of])
            if len(docs) == len(own):
                text, hits, first = buffer, where[of], begins[docs]
            else:  # the texts that the rule has hit, with the separators behind them
                text = np.concatenate([buffer[begins[d] : ends[d]] for d in docs])
                first = np.concatenate([[0], np.cumsum(ends[docs] - begins[docs])[:-1]])
                hits = where[of] - (begins[docs] - first)[np.searchsorted(docs, doc[of])]
            raw = text.tobytes()
            for lo_, hi_ in stretches(text, machine.alone[r], hits):
                at = int(np.searchsorted(first, lo_, side="right")) - 1
                base = lo_ - int(first[at])
                found.setdefault(int(docs[at]), []).extend((base + b, r, base + e) for b, e in spans_of(raw[lo_:hi_], r, machine))
        for d, spans in found.items():
            cuts = sorted({x for b, _, e in spans for x in (b, e)})
            points, seen, at = {}, 0, 0
            for cut in cuts:
                seen, at = seen + len(own[d][at:cut].decode("utf-8", "replace")), cut
                points[cut] = seen
            out[lo + d] = sorted((points[b], r, points[e]) for b, r, e in spans)
    return out


def scan_column(spark, rules: tuple[Rule, ...] = BASE + MORE):
    """A column function text -> array of struct(kind, begin, end), spans by start and then in the order of the rules."""
    small_batches(spark)
    machine = scanner(rules)  # its size depends on the rules only

    @F.arrow_udf("array<struct<kind: string, begin: int, end: int>>")
    def spans(texts: pa.Array) -> pa.Array:
        found = find_secrets(blobs(texts), machine)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))
        return pa.array([[{"kind": machine.rules[r].kind, "begin": b, "end": e} for b, r, e in own] for own in found], kind)

    return spans


def scan_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``doc_id, found`` for every row, where ``found`` lists ``kind, begin, end`` in code points, end exclusive.

    Null and empty texts have no spans.  Texts are scanned whole, whatever their length.  Spans of different kinds may
    overlap; of one kind they don't.  Repeated rows are scanned each; an empty table gives no rows; other columns are not
    read, so their names can't clash.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), scan_column(docs.sparkSession, rules)(F.col(text)).alias("found"))


def digest_spans(found: DataFrame, kinds: list[str]) -> DataFrame:
    """Counts and digests of spans.  ``kinds`` are the base kinds; counts are of those."""
    join = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")
    base = F.filter("found", lambda s: s["kind"].isin(kinds))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(join(base), 256).alias("base_sha256"),
        join(F.col("found")).alias("spans"),
    )


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    return digest_spans(scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")), [r.kind for r in BASE])
