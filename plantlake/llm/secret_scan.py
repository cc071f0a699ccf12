"""Secret scan: all rules in one deterministic automaton, one pass over the bytes.

Each rule is a regular expression over bytes.  All rules together become one
NFA, which subset construction turns into a DFA that looks for every rule at
every position; Moore's refinement minimises it, and it is stored as a flat
transition array of 256 entries per state.  The scan reads each byte once.
A state without any half-read match is *idle*; no match spans an idle point,
so the text falls into active segments, and only a segment in which a rule
accepted is looked at again, to name the leftmost longest spans of that rule
with the rule's own small automaton: backwards first, to mark where a match
begins and how far it can go, then forwards through the matches alone.  Both
passes are linear, whatever the bytes are.

Spark part: an Arrow UDF over the text column (a map, no shuffle).

Edge cases: a null text is empty and has no spans; positions are code points,
end exclusive; repeated rows are each reported; texts are scanned whole, in
linear time, with 1 byte more per byte of a segment that holds a match (4 for
rules with over 256 live sets); an empty table gives an empty one; only the
text column is read, so other columns may have any names but ``into``.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow_text import raw_bytes, slices


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost longest matches; one shorter than ``least`` is dropped after
    it has used up its text.  With ``head``, the length counts from the end of ``head``'s match."""

    kind: str
    pattern: str
    least: int = 1
    head: str | None = None
    any_case: bool = False


_ASSIGN_HEAD = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""

#: The contract's three kinds, in its order.
BASE_RULES = (
    Rule("assign", _ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]+", 12, _ASSIGN_HEAD, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),  # same spans as [0-9a-f]+ of 16 or more: both are whole runs
)
#: Public token formats that the method adds.
MORE_RULES = (
    # The key itself, too, where its closing line follows; else the opening line alone.
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----([A-Za-z0-9+/=:,.\x09\x0A\x0D\x20]*"
                        r"-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
)
RULES = BASE_RULES + MORE_RULES
MASK = "[SECRET]"


class _Nfa:
    """Thompson construction of the rules' byte expressions."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.step: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.step.append(None)
        return len(self.step) - 1

    def add(self, rule: Rule, pattern: str) -> tuple[int, int]:
        self.text, self.at, self.any_case = pattern, 0, rule.any_case
        start, end = self._choice()
        if self.at != len(pattern):
            raise ValueError(f"unexpected {pattern[self.at:]!r} in {pattern!r}")
        return start, end

    def _peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def _take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def _choice(self):
        start, end = self.state(), self.state()
        while True:
            s, e = self._sequence()
            self.empty[start].append(s)
            self.empty[e].append(end)
            if self._peek() != "|":
                return start, end
            self._take()

    def _sequence(self):
        start = end = self.state()
        while self._peek() not in ("", "|", ")"):
            s, e = self._repeated()
            self.empty[end].append(s)
            end = e
        return start, end

    def _repeated(self):
        begun = self.at
        s, e = self._atom()
        mark = self._peek()
        if mark and mark in "*+?":
            self._take()
            return self._loop(s, e, mark in "*?", mark in "*+")
        if mark == "{":  # {n,}: n copies, the last one repeatable
            stop = self.text.index("}", self.at)
            least, more = self.text[self.at + 1:stop].split(",")
            if more:
                raise ValueError("only {n,} is known")
            for _ in range(int(least) - 1):
                self.at = begun
                s2, e2 = self._atom()
                self.empty[e].append(s2)
                last, e = s2, e2
            self.at = stop + 1
            self.empty[e].append(last)
        return s, e

    def _loop(self, s, e, skip, again):
        start, end = self.state(), self.state()
        self.empty[start].append(s)
        self.empty[e].append(end)
        if skip:
            self.empty[start].append(end)
        if again:
            self.empty[e].append(s)
        return start, end

    def _atom(self):
        c = self._take()
        if c == "(":
            inner = self._choice()
            if self._take() != ")":
                raise ValueError("missing )")
            return inner
        chars = self._class() if c == "[" else {self._escape() if c == "\\" else ord(c)}
        if self.any_case:
            chars |= {ord(chr(b).swapcase()) for b in chars if b < 128 and chr(b).isalpha()}
        s, e = self.state(), self.state()
        self.step[s] = (frozenset(chars), e)
        return s, e

    def _escape(self) -> int:
        c = self._take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return ord(c)

    def _class(self) -> set[int]:
        chars: set[int] = set()
        while (c := self._take()) != "]":
            low = self._escape() if c == "\\" else ord(c)
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self._take()
                c = self._take()
                chars |= set(range(low, (self._escape() if c == "\\" else ord(c)) + 1))
            else:
                chars.add(low)
        return chars

    def closures(self) -> list[int]:
        """Bit set of the states reachable without a byte, for each state."""
        out = []
        for s in range(len(self.step)):
            seen, todo = {s}, [s]
            while todo:
                for t in self.empty[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            out.append(sum(1 << t for t in seen))
        return out


def _bits(x: int):
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


class Dfa:
    """A minimised DFA: ``move`` (256 entries a state), ``accepts`` (bit set of rules a state).

    ``search``: matches may begin at every byte, and state 0 is the idle state.
    Otherwise a match begins at the first byte, and state 1 is the dead state.
    """

    def __init__(self, rules: list[tuple[Rule, str]], search: bool):
        nfa = _Nfa()
        ends, starts = {}, []
        for k, (rule, pattern) in enumerate(rules):
            s, e = nfa.add(rule, pattern)
            starts.append(s)
            ends[e] = 1 << k
        closed = nfa.closures()
        first = 0
        for x in starts:
            first |= closed[x]
        kinds: dict[tuple, int] = {}  # bytes that every rule treats alike
        sets = sorted({st[0] for st in nfa.step if st}, key=sorted)
        byte_kind = [kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)]
        sample = [byte_kind.index(k) for k in range(len(kinds))]
        # Per NFA state with a byte step: (bytes' kinds, closed goal).
        steps = {i: ([k for k, x in enumerate(sample) if x in st[0]], closed[st[1]])
                 for i, st in enumerate(nfa.step) if st}
        moving, always = sum(1 << i for i in steps), first if search else 0
        number = {first: 0}
        todo, rows = [first], []
        if not search:
            number[0] = 1
            todo.append(0)
        for states in todo:
            goals = [always] * len(sample)
            for i in _bits(states & moving):
                on, goal = steps[i]
                for k in on:
                    goals[k] |= goal
            for goal in goals:
                if goal not in number:
                    number[goal] = len(todo)
                    todo.append(goal)
            rows.append([number[g] for g in goals])
        table = np.array(rows)
        labels = np.array([sum(label for e, label in ends.items() if states >> e & 1) for states in todo])
        self.raw_states = len(todo)
        group = np.unique(np.stack([labels, np.arange(len(todo)) == 0], 1), axis=0, return_inverse=True)[1].ravel()
        while True:  # Moore: split groups until equal states agree on every next group
            finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == group.max():
                break
            group = finer
        order = list(dict.fromkeys(group.tolist()))  # state 0 stays first, the dead state second
        place = {g: i for i, g in enumerate(order)}
        members = [int(np.flatnonzero(group == g)[0]) for g in order]
        self.move = array("H", [place[int(group[table[m][byte_kind[b]]])] for m in members for b in range(256)])
        self.accepts = [int(labels[m]) for m in members]
        self.states = len(members)
        # Run backwards: the sets of states that still lead to a match, numbered as they turn up.
        self.live, self._number, self._back = [0], {0: 0}, {}

    def ahead(self, data: bytes, at: int, end: int):
        """For each position of ``data[at:end]``, and for its end: the number, in ``live``, of the set of
        states from which the bytes from there on still reach a match.  One backward pass."""
        back, now = self._back, 0
        sets: bytearray | array = bytearray(end - at + 1)
        for i in range(end - 1, at - 1, -1):
            key = now << 8 | data[i]
            now = back.get(key, -1)
            if now < 0:
                now = back[key] = self._before(key)
            if now > 255 and isinstance(sets, bytearray):
                sets = array("I", sets)
            sets[i - at] = now
        return sets

    def _before(self, key: int) -> int:
        later, byte = self.live[key >> 8], key & 255
        states = 0
        for s in range(self.states):
            goal = self.move[s << 8 | byte]
            if self.accepts[goal] or later >> goal & 1:
                states |= 1 << s
        if states not in self._number:
            self._number[states] = len(self.live)
            self.live.append(states)
        return self._number[states]

    def matches(self, data: bytes, at: int, end: int):
        """Leftmost longest matches (start, end) in ``data[at:end]``, in linear time: a run begins only
        where a match does, and ends where none can follow (``search=False`` only)."""
        move, accepts, live = self.move, self.accepts, self.live
        sets = self.ahead(data, at, end)
        i = at
        while i < end:
            if not live[sets[i - at]] & 1:
                i += 1
                continue
            state, stop, k = 0, i, i
            while k < end and live[sets[k - at]] >> state & 1:
                state = move[state << 8 | data[k]]
                k += 1
                if accepts[state]:
                    stop = k
            yield i, stop
            i = stop

    def longest(self, data: bytes, at: int, end: int) -> int:
        """End of the longest match that begins at ``at``, or -1 (``search=False`` only)."""
        move, accepts, state, best = self.move, self.accepts, 0, -1
        for i in range(at, end):
            state = move[state << 8 | data[i]]
            if state == 1:
                break
            if accepts[state]:
                best = i + 1
        return best


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.all = Dfa([(r, r.pattern) for r in rules], search=True)
        self.own = [Dfa([(r, r.pattern)], search=False) for r in rules]
        self.head = [Dfa([(r, r.head)], search=False) if r.head else None for r in rules]
        self._link()

    def __getstate__(self):
        return self.rules, self.all, self.own, self.head

    def __setstate__(self, state):
        self.rules, self.all, self.own, self.head = state
        self._link()

    def _link(self) -> None:
        """Rows for the first pass: a row's entries are the next rows; accepting states absorb."""
        rows: list[list] = [[] for _ in range(self.all.states)]
        self.hit: list = []
        self.hit.extend([self.hit] * 256)
        target = [self.hit if a else r for a, r in zip(self.all.accepts, rows)]
        for s, row in enumerate(rows):
            row.extend(target[t] for t in self.all.move[s << 8:(s + 1) << 8])
        self.start = rows[0]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule number, end) in bytes, sorted."""
        row = self.start
        for c in data:
            row = row[c]
        if row is not self.hit:
            return []
        move, accepts = self.all.move, self.all.accepts
        out: list[tuple[int, int, int]] = []
        state = begun = seen = 0
        for i, c in enumerate(data):
            state = move[state << 8 | c]
            if state == 0:
                if seen:
                    self._resolve(data, begun, i + 1, seen, out)
                    seen = 0
                begun = i + 1
            else:
                seen |= accepts[state]
        if seen:
            self._resolve(data, begun, len(data), seen, out)
        return sorted(out)

    def _resolve(self, data, at, end, seen, out) -> None:
        for k, rule in enumerate(self.rules):
            if not seen >> k & 1:
                continue
            for start, stop in self.own[k].matches(data, at, end):
                begin = self.head[k].longest(data, start, stop) if self.head[k] else start
                if stop - begin >= rule.least:
                    out.append((start, k, stop))


_BUILT: dict = {}


def scanner(spark: SparkSession, rules: tuple[Rule, ...] = RULES):
    """The rules' scanner, built once on the driver and broadcast (its size depends on the rules only)."""
    key = spark.sparkContext.applicationId, rules
    if key not in _BUILT:
        _BUILT[key] = spark.sparkContext.broadcast(Scanner(rules))
    return _BUILT[key]


def _code_points(data: bytes, spans):
    """The same spans in code points."""
    place, last, count = {}, 0, 0
    for b in sorted({x for s in spans for x in (s[0], s[2])}):
        count += len(data[last:b].decode("utf-8", "surrogatepass"))
        last, place[b] = b, count
    return [(place[s], k, place[e]) for s, k, e in spans]


def _texts(texts: pa.Array):
    for piece in slices(texts):
        offsets, data = raw_bytes(piece)
        for a, b in zip(offsets[:-1], offsets[1:]):
            yield data[a:b]


def _masked(data: bytes, spans, mask: bytes) -> bytes:
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [data[at:s], mask]
        at = max(at, e)
    return b"".join([*out, data[at:]])


def span_column(spark: SparkSession, text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Array of (kind, start, end) of all rules' spans, by start, then in the order of the rules."""
    shared = scanner(spark, rules)

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def scan(texts: pa.Array) -> pa.Array:
        found = shared.value
        out = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in _code_points(d, found.spans(d))]
               for d in _texts(texts)]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        return pa.array(out, pa.list_(kind))

    return scan(text)


def scan_secrets(docs: DataFrame, *, text_col: str = "text", into: str = "secrets",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the array ``into`` of (kind, start, end); ``into`` must be a new name."""
    return docs.withColumn(into, span_column(docs.sparkSession, F.col(text_col), rules))


def redact_secrets(docs: DataFrame, *, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
                   mask: str = MASK) -> DataFrame:
    """``docs`` with every span in ``text_col`` (overlapping ones as one) replaced by ``mask``; null stays null."""
    shared = scanner(docs.sparkSession, rules)

    @F.arrow_udf("string")
    def redact(texts: pa.Array) -> pa.Array:
        found, put = shared.value, mask.encode()
        out = [_masked(d, found.spans(d), put) for d in _texts(texts)]
        return pa.array(out, pa.binary()).cast(pa.string())

    text = F.col(text_col)
    return docs.withColumn(text_col, F.when(text.isNotNull(), redact(text)))
