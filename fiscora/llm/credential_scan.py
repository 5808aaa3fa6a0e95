"""Secret scans: base patterns, and formats inferred as probabilistic automata.

Labelled credentials (all values that the base patterns find in any row, and a seeded set of public token formats) are
counted in one prefix tree per kind, over character classes, or the character itself at a position where nearly all
tokens of the kind have the same one.  States whose outgoing frequencies are statistically compatible (Hoeffding's
bound, at every depth below them) are merged, breadth first; then all tokens, whole, are read by what is left and its
transitions are counted, which gives a probabilistic automaton.

Every candidate of every text, of any length, is scored: each run of token characters, or what base spans leave of it,
and where a run is no secret as a whole, its parts between `=` and `/`.  The score is the log-likelihood ratio of the
best automaton against a character model of ordinary tokens.  A span of kind `format` needs a mean ratio a character of
`MARGIN` and a ratio of the evidence that the fit sets: `EVIDENCE` at least (a token is rarely a secret to begin with),
and `SAFETY` times what ordinary tokens reach in texts that the character model has not seen: the ratio that at most
one in `RARE` of them exceeds (of fewer tokens, the highest).

The fit counts every row and whole texts, nothing is sampled: the texts are read once for the counts (labelled values;
character trigrams of the ordinary tokens, in two halves by the text's CRC), half of them again for the evidence.  What
the driver gets is bounded by the alphabet and the model: trigrams, characters by position, states of a tree that at
least two and one in `RESOLUTION` of a kind's tokens reach (others are like the root: Hoeffding's test can tell no state
of one token from it), transitions, and a histogram.  A tree tells apart the first `DEPTH` characters of a token.

Defined cases: a null or empty text has no spans; base spans are always kept, format spans lie outside of them;
equal rows give equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise

# The contract's patterns, in the order of kinds.  A run of 24 characters or more is what is left of
# `[0-9a-f]+` once shorter matches are dropped, and so for AKIA.
KINDS = ("assign", "access", "hex", "format")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]+")
_PART = re.compile(r"[^/=]+")
_RUN = re.compile(r"[A-Za-z0-9]{12,}")
#: Shorter values are no labelled examples of a format.
LABELLED_MIN = 16
#: The least ratio of a span (what twelve random letters and digits reach); the mean ratio a character; see above.
EVIDENCE, MARGIN, SAFETY = 45.0, 1.0, 1.15
#: What it costs an ordinary word to be in capitals.
CAPITALS = 3.0
#: Share of a kind's tokens that makes a character the literal of its position.
LITERAL_SHARE = 0.9
#: Candidates whose result a worker remembers.
REMEMBERED = 200_000
#: Ordinary tokens of which one may exceed the evidence (before SAFETY).
RARE = 100_000
#: A state of a tree is reached by one in so many tokens of its kind at least; characters of a token in the tree.
RESOLUTION, DEPTH = 1000, 200
#: Bins of the evidence's histogram, by the logarithm of the ratio.
BINS = 1024
#: Distinct counts that a worker holds.
HELD = 200_000

#: Marks that may join a token to a base span.
JOINTS = frozenset("+/_=.-")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base patterns: leftmost, non-overlapping in each kind, ordered by start and kind."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


class Automaton:
    """Deterministic probabilistic automaton: for each state, the next state and log-probability by symbol.

    A symbol is a character, or its literal form where the position has a literal.
    """

    def __init__(self, steps: list[dict[str, tuple[int, float]]], literals: list[str | None], floor: float):
        self.steps, self.literals, self.floor = steps, literals, floor

    def score(self, token: str, least: float = -math.inf) -> float:
        """Sum of log-probabilities; a character without a transition costs `floor` and keeps the state.

        The sum only falls: it ends as soon as it is below `least`.
        """
        state, total, steps, literals = 0, 0.0, self.steps, self.literals
        for i, ch in enumerate(token):
            step = None
            if i < len(literals) and literals[i] == ch:
                step = steps[state].get("=" + ch)
            step = step or steps[state].get(ch)
            if step is None:
                total += self.floor
            else:
                state = step[0]
                total += step[1]
            if total < least:
                break
        return total


def _shape(ch: str) -> str:
    return "0" if ch.isdigit() else "a" if ch.islower() else "A" if ch.isupper() else ch


def counted_characters(tokens: Iterable[tuple[str, int]]) -> Counter:
    """How often each (position, character) is, and how many tokens there are at position -1."""
    found: Counter = Counter()
    for token, n in tokens:
        found[-1, ""] += n
        for i, ch in enumerate(token[:DEPTH]):
            found[i, ch] += n
    return found


def literal_places(found: Counter) -> list[str | None]:
    """The character that nearly all tokens have at a position, up to the last such position."""
    total = found[-1, ""]
    if total < 2:
        return []
    best = {i: ch for (i, ch), n in found.items() if i >= 0 and n >= LITERAL_SHARE * total}
    return [best.get(i) for i in range(max(best, default=-1) + 1)]


def symbols_of(token: str, literals: list[str | None]) -> list[str]:
    """Each character's class, or its literal form where the position has a literal."""
    return ["=" + ch if i < len(literals) and literals[i] == ch else _shape(ch) for i, ch in enumerate(token)]


_FACTOR, _WRAP = 0x9E3779B97F4A7C15, (1 << 64) - 1


def counted_nodes(tokens: Iterable[tuple[str, int]], literals: list[str | None]) -> Counter:
    """How many tokens reach each node (node, parent, symbol) of the prefix tree, and end there (node, node, "").

    A node is known by a 64-bit hash of its prefix; the root is 0.
    """
    found: Counter = Counter()
    for token, n in tokens:
        node, symbols = 0, symbols_of(token[:DEPTH], literals)
        for c in symbols:
            h = (node + 1) * _FACTOR + sum(ord(x) << (16 * j) for j, x in enumerate(c))
            h = ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9) & _WRAP
            child = (h ^ (h >> 32)) - (1 << 63)
            found[child, node, c] += n
            node = child
        if len(token) <= DEPTH:
            found[node, node, ""] += n
    return found


class Tree:
    """A prefix tree with counts, whose states can be folded into one another."""

    def __init__(self, nodes: dict[tuple[int, int, str], int]) -> None:
        """nodes: as counted, without rare ones."""
        below: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for child, node, c in nodes:
            if c:
                below[node].append((c, child))
        self.kids: list[dict[str, int]] = []
        self.count: list[Counter] = []
        self.ends: list[int] = []
        number, queue = {0: 0}, [0]
        for node in queue:
            self.ends.append(nodes.get((node, node, ""), 0))
            self.kids.append({})
            self.count.append(Counter())
            for c, child in sorted(below[node]):
                self.count[-1][c] += nodes[child, node, c]
                self.kids[-1][c] = number[child] = len(number)
                queue.append(child)

    def size(self, s: int) -> int:
        return self.ends[s] + sum(self.count[s].values())

    def compatible(self, a: int, b: int, alpha: float) -> bool:
        """Whether Hoeffding's test finds no difference between the states, nor between what follows them alike."""
        spread, queue, done = math.sqrt(0.5 * math.log(2 / alpha)), [(a, b)], set()
        while queue:
            x, y = queue.pop()
            if x == y or (x, y) in done:
                continue
            done.add((x, y))
            n, m = self.size(x), self.size(y)
            if n and m:
                apart = spread * (1 / math.sqrt(n) + 1 / math.sqrt(m))
                shares = [(self.ends[x], self.ends[y]), *((self.count[x][c], self.count[y][c]) for c in self.count[x].keys() | self.count[y].keys())]
                if any(abs(f / n - g / m) > apart for f, g in shares):
                    return False
            queue += [(self.kids[x][c], self.kids[y][c]) for c in self.kids[x].keys() & self.kids[y].keys()]
        return True

    def fold(self, a: int, b: int) -> None:
        queue = [(a, b)]
        while queue:
            x, y = queue.pop()
            if x == y:
                continue
            self.ends[x] += self.ends[y]
            self.count[x] += self.count[y]
            for c, child in self.kids[y].items():
                if c in self.kids[x]:
                    queue.append((self.kids[x][c], child))
                else:
                    self.kids[x][c] = child


def merged(nodes: dict[tuple[int, int, str], int], alpha: float = 0.05) -> list[dict[str, int]]:
    """For each state, the next state by symbol: the prefix tree, merged state by state while no difference is found.

    Classes (digit, lower, upper, or the mark itself) keep the tree small.  The states still open are looked up anew after
    every fold, as a fold can hang children on states that are settled; so no transition is lost.
    """
    tree = Tree(nodes)
    settled = {0: 0}  # state to number, in order
    while True:
        open_ = ((s, c, k) for s in settled for c, k in sorted(tree.kids[s].items()) if k not in settled)
        parent, symbol, state = next(open_, (None, None, None))
        if state is None:
            return [{c: settled[k] for c, k in tree.kids[s].items()} for s in settled]
        like = next((s for s in settled if tree.compatible(s, state, alpha)), None)
        if like is None:
            settled[state] = len(settled)
        else:
            tree.kids[parent][symbol] = like
            tree.fold(like, state)


def counted_steps(tokens: Iterable[tuple[str, int]], literals: list[str | None], states: list[dict[str, int]]) -> Counter:
    """How often whole tokens take each (state, symbol), how often they end (state, ""), and (-1, "symbol character") is seen.

    A symbol without a transition leads to the root, as rare states are like it.
    """
    found: Counter = Counter()
    for token, n in tokens:
        state = 0
        for ch, c in zip(token, symbols_of(token, literals)):
            found[state, c] += n
            found[-1, c + " " + ch] += n
            state = states[state].get(c, 0)
        found[state, ""] += n
    return found


def automaton(literals: list[str | None], states: list[dict[str, int]], found: dict[tuple[int, str], int]) -> Automaton:
    """A class's mass is spread over the characters seen in it."""
    seen: dict[str, list[str]] = defaultdict(list)
    for at, c in sorted(found):
        if at < 0:
            symbol, ch = c.split(" ")
            seen[symbol].append(symbol if len(symbol) > 1 else ch)
    size: Counter = Counter()
    for (at, _), n in found.items():
        size[at] += n
    steps: list[dict[str, tuple[int, float]]] = [{} for _ in states]
    for (at, c), n in sorted(found.items()):
        if at >= 0 and c:
            steps[at].update((ch, (states[at].get(c, 0), math.log(n / (size[at] + 1.0) / len(seen[c])))) for ch in seen[c])
    return Automaton(steps, literals, math.log(1e-4))


def frequent(nodes: dict[tuple[int, int, str], int], total: int) -> dict[tuple[int, int, str], int]:
    """The nodes that two tokens and one in RESOLUTION reach, with the ends at them."""
    kept = {k: n for k, n in nodes.items() if k[2] and n >= max(2, total / RESOLUTION)}
    here = {0, *(k[0] for k in kept)}
    return kept | {k: n for k, n in nodes.items() if not k[2] and k[0] in here}


def infer(tokens: list[str]) -> Automaton:
    counted = list(Counter(tokens).items())
    literals = literal_places(counted_characters(counted))
    states = merged(frequent(counted_nodes(counted, literals), len(tokens)))
    return automaton(literals, states, counted_steps(counted, literals, states))


#: What stands before a token in the trigrams.
START = "\x02\x02"
_SIGNS = "\x02" + "".join(ch for ch in map(chr, range(128)) if _CANDIDATE.match(ch))
_SIGN = np.zeros(128, np.int64)
_SIGN[[ord(ch) for ch in _SIGNS]] = np.arange(len(_SIGNS))


def counted_trigrams(tokens: dict[str, int]) -> np.ndarray:
    """How often each trigram of _SIGNS is in the tokens, START before each."""
    k, words = len(_SIGNS), list(tokens)
    at = _SIGN[np.frombuffer((START + START.join(words) + START).encode("ascii"), np.uint8)]
    times = np.repeat(np.fromiter(tokens.values(), np.int64, len(words)), np.fromiter(map(len, words), np.int64, len(words)) + 2)
    gram = (at[:-2] * k + at[1:-1]) * k + at[2:]
    inside = at[2:] > 0
    return np.bincount(gram[inside], times[inside], k**3).astype(np.int64)


def _mixed(run: str) -> bool:
    return any(map(str.isdigit, run)) and any(map(str.isalpha, run))


class Ordinary:
    """Character-trigram model of ordinary tokens, with back-off to pairs and single characters."""

    def __init__(self, tokens: Iterable[str] = (), grams: dict[str, int] | None = None):
        """Tokens, and counted trigrams of others; pairs and characters follow from the trigrams."""
        self.n3: Counter = Counter(grams or {})
        for t in tokens:
            t = START + t
            self.n3.update(t[i : i + 3] for i in range(len(t) - 2))
        self.n2: Counter = Counter()
        for g, n in self.n3.items():
            self.n2[g[1:]] += n
        firsts = sum(n for g, n in self.n3.items() if g[:2] == START)
        self.n2[START] += firsts
        self.n1: Counter = Counter({START[0]: firsts} if firsts else {})
        for g, n in self.n2.items():
            self.n1[g[1]] += n
        self.total = 1 + sum(self.n1.values())
        self.memo: dict[str, float] = {}

    def score(self, token: str) -> float:
        """Log-probability; a word in capitals, or with a capital, is also taken as the word in small letters."""
        found = self._score(token)
        if token.isalpha() and (token.isupper() or token.istitle()):
            found = max(found, self._score(token.lower()) - CAPITALS)
        return found

    def _score(self, token: str) -> float:
        t, memo, total = "\x02\x02" + token, self.memo, 0.0
        for i in range(len(t) - 2):
            g = t[i : i + 3]
            p = memo.get(g)
            if p is None:
                one = (self.n1[g[2]] + 1) / (self.total + 128)
                two = (self.n2[g[1:]] + 4 * one) / (self.n1[g[1]] + 4)
                p = memo[g] = math.log((self.n3[g] + 4 * two) / (self.n2[g[:2]] + 4))
            total += p
        return total


def _outside(a: int, b: int, taken: list[tuple[int, int]], i: int) -> Iterator[tuple[int, int]]:
    """The pieces of a to b outside of the sorted spans from the i-th on."""
    while i < len(taken) and taken[i][0] < b:
        if taken[i][0] > a:
            yield a, taken[i][0]
        a = max(a, taken[i][1])
        i += 1
    if b > a:
        yield a, b


class FormatModel:
    def __init__(self, automata: list[Automaton], ordinary: Ordinary, evidence: float):
        self.automata, self.ordinary, self.evidence = automata, ordinary, evidence
        self.memo: dict[str, tuple[tuple[int, int], ...]] = {}

    def ratio(self, token: str, least: float = -math.inf) -> float:
        """Log-likelihood ratio of the best automaton against ordinary tokens; below `least` it may be any value below."""
        common = self.ordinary.score(token)
        if -common < least:  # an automaton gives a probability of one at most
            return -math.inf
        return max((a.score(token, least + common) for a in self.automata), default=-math.inf) - common

    def is_secret(self, token: str) -> bool:
        least = max(self.evidence, MARGIN * len(token))
        return bool(token) and self.ratio(token, least) >= least

    def pieces(self, run: str) -> tuple[tuple[int, int], ...]:
        """The secrets in a run of token characters: the whole run, or else its parts between marks."""
        known = self.memo.get(run)
        if known is None:
            if len(self.memo) >= REMEMBERED:
                self.memo.clear()
            whole = run.rstrip(".")
            if self.is_secret(whole):
                known = ((0, len(whole)),)
            elif "=" in run or "/" in run:
                parts = ((m.start(), m.group().rstrip(".")) for m in _PART.finditer(run))
                known = tuple((a, a + len(t)) for a, t in parts if self.is_secret(t))
            else:
                known = ()
            self.memo[run] = known
        return known

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        if not self.automata:
            return []
        if not base and not any(self.pieces(run) for run in set(_CANDIDATE.findall(text))):
            return []
        found, taken, i = [], sorted((a, b) for a, b, _ in base), 0
        for m in _CANDIDATE.finditer(text):
            a, b = m.span()
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            for p, q in _outside(a, b, taken, i):
                # a mark beside a base span may be a joint or a part of the token: without it first, then with it
                cut = p + (p > a and text[p] in JOINTS), q - (q < b and text[q - 1] in JOINTS)
                for x, y in dict.fromkeys((cut, (p, q))):
                    hits = self.pieces(text[x:y])
                    if hits:
                        found += [(x + u, x + v, "format") for u, v in hits]
                        break
        return found


def public_formats(count: int = 150, seed: int = 5) -> dict[str, list[str]]:
    """Made credentials of public token formats, for kinds that a corpus may lack."""
    rnd = random.Random(seed)
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def run(chars: str, n: int) -> str:
        return "".join(rnd.choice(chars) for _ in range(n))

    both = digits + lower + upper
    makers = {
        "github": lambda: f"gh{rnd.choice('pousr')}_{run(both, 36)}",
        "stripe": lambda: f"{rnd.choice(('sk', 'pk', 'rk'))}_{rnd.choice(('live', 'test'))}_{run(both, 24)}",
        "slack": lambda: f"xox{rnd.choice('bpars')}-{run(digits, 12)}-{run(digits, 12)}-{run(both, 24)}",
        "google": lambda: f"AIza{run(both + '-_', 35)}",
        "jwt": lambda: f"eyJ{run(both, 33)}.eyJ{run(both + '-_', 60)}.{run(both + '-_', 43)}",
        "base64": lambda: run(both + "+/", 40),
        "aws": lambda: f"AKIA{run(upper + digits, 16)}",
    }
    return {k: [f() for _ in range(count)] for k, f in makers.items()}


def plain_tokens(count: int = 4000, seed: int = 6) -> list[str]:
    """Made numbers and names of accounts, as ordinary tokens that a sample may lack."""
    rnd = random.Random(seed)
    name = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(4, 9)))
    makers = (lambda: f"{name()}.{rnd.randrange(100):02d}", lambda: f"{name()}_{name()}", lambda: str(rnd.randrange(10 ** rnd.randint(1, 16))), lambda: f"{rnd.randint(1900, 2099)}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}", lambda: f"{rnd.randrange(1000)}-{rnd.randrange(10000)}", lambda: f"{rnd.randrange(10**6)}.{rnd.randrange(100)}")
    return [rnd.choice(makers)() for _ in range(count)]


def half_of(text: str) -> int:
    return zlib.crc32(text.encode()) & 1


def ordinary_tokens(text: str, base: list[Span]) -> Iterator[str]:
    """Tokens that meet no base span; letters and digits mixed in one long run may be credentials without a label."""
    if base:
        found = [text[a:b] for a, b in clear_runs(text, base)]
    else:
        found = _CANDIDATE.findall(text)
    for t in found:
        t = t.rstrip(".")
        if t and not (len(t) >= 12 and any(_mixed(run) for run in _RUN.findall(t))):
            yield t


def clear_runs(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """The candidates that overlap no base span, in one sweep."""
    taken, i, reach = sorted((a, b) for a, b, _ in base), 0, 0
    for m in _CANDIDATE.finditer(text):
        while i < len(taken) and taken[i][0] < m.end():
            reach, i = max(reach, taken[i][1]), i + 1
        if reach <= m.start():
            yield m.span()


def gathered(texts: Iterable[tuple[str, int]]) -> Iterator[Counter]:
    """(kind, token) of labelled values and (half, trigram) of ordinary tokens, counted; texts come with their half."""
    labelled: Counter = Counter()
    tokens: tuple[Counter, Counter] = (Counter(), Counter())
    grams = np.zeros((2, len(_SIGNS) ** 3), np.int64)

    def settle(half: int) -> None:
        if tokens[half]:
            grams[half] += counted_trigrams(tokens[half])
            tokens[half].clear()

    for text, half in texts:
        base = base_spans(text)
        for a, b, kind in base:
            m = _ASSIGN.match(text, a, b) if kind == "assign" else None
            token = m.group(2) if m else text[a:b]
            if len(token) >= LABELLED_MIN:
                labelled[kind, token] += 1
        tokens[half].update(ordinary_tokens(text, base))
        if len(tokens[half]) >= HELD:
            settle(half)
        if len(labelled) >= HELD:
            yield labelled
            labelled = Counter()
    for half in (0, 1):
        settle(half)
        for g in np.flatnonzero(grams[half]).tolist():
            k = len(_SIGNS)
            labelled[str(half), _SIGNS[g // k // k] + _SIGNS[g // k % k] + _SIGNS[g % k]] += int(grams[half][g])
    yield labelled


def high_ratios(texts: Iterable[str], model: FormatModel) -> Counter:
    """How many ordinary tokens have a ratio in each bin, of ratios that may raise the evidence."""
    found: Counter = Counter()
    known: dict[str, int | None] = {}
    least = EVIDENCE / SAFETY
    for text in texts:
        for token in ordinary_tokens(text, base_spans(text)):
            if token not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                ratio = model.ratio(token, least)
                known[token] = math.ceil(math.log(ratio) * BINS) if ratio >= least else None
            if known[token] is not None:
                found[known[token]] += 1
    return found


def evidence_of(found: dict[int, int], tokens: int) -> float:
    """SAFETY times the ratio that one in RARE tokens exceeds at most, EVIDENCE at least."""
    above = 0
    for at in sorted(found, reverse=True):
        above += found[at]
        if above > tokens // RARE:
            return max(EVIDENCE, SAFETY * math.exp(at / BINS))
    return EVIDENCE


def fitted(automata: list[Automaton], grams: tuple[dict[str, int], dict[str, int]], high: Callable[[FormatModel, int], dict[int, int]]) -> FormatModel:
    """The half with more tokens teaches, the other (given to `high`) sets the evidence; then both teach."""
    made = plain_tokens()
    tokens = [sum(n for g, n in half.items() if g[:2] == START) for half in grams]
    other = 0 if tokens[1] > tokens[0] else 1
    evidence = EVIDENCE
    if tokens[other]:
        evidence = evidence_of(high(FormatModel(automata, Ordinary(made, grams[1 - other]), EVIDENCE), other), tokens[other])
    return FormatModel(automata, Ordinary(made, Counter(grams[0]) + Counter(grams[1])), evidence)


def public_automata() -> list[Automaton]:
    return [infer(t) for t in public_formats().values()]


def train(texts: list[str | None]) -> FormatModel:
    """The model of texts at hand, as `learn` fits it to a table."""
    whole = [(t, half_of(t)) for t in texts if t]
    counted: Counter = Counter()
    for part in gathered(whole):
        counted += part
    automata = public_automata()
    for kind in KINDS[:3]:
        tokens = [(t, n) for (k, t), n in counted.items() if k == kind]
        if tokens:
            literals = literal_places(counted_characters(tokens))
            states = merged(frequent(counted_nodes(tokens, literals), sum(n for _, n in tokens)))
            automata.append(automaton(literals, states, counted_steps(tokens, literals, states)))
    grams = tuple({t: n for (k, t), n in counted.items() if k == str(half)} for half in (0, 1))
    return fitted(automata, grams, lambda model, half: high_ratios((t for t, h in whole if h == half), model))


def _by_kind(tokens: DataFrame, count: Callable[[str, list[tuple[str, int]]], Counter], fields: str) -> DataFrame:
    """`count` over all (kind, token, n) in pieces, summed: kind, the fields of its keys, and n."""
    names = [f.split()[0] for f in fields.split(", ")]
    types = [pa.int64() if f.endswith("long") else pa.string() for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, words, times = (c.to_pylist() for c in batch.columns)
            for kind in sorted(set(kinds)):
                found = count(kind, [(t, n) for k, t, n in zip(kinds, words, times) if k == kind])
                keys = list(zip(*found)) or [()] * len(names)
                columns = [pa.array([kind] * len(found)), *map(pa.array, keys, types), pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["kind", *names, "n"])

    return tokens.mapInArrow(run, f"kind string, {fields}, n long").groupBy("kind", *names).agg(F.sum("n").alias("n"))


def _collected(found: DataFrame) -> dict[str, Counter]:
    out: dict[str, Counter] = defaultdict(Counter)
    for row in found.toArrow().to_pylist():
        kind, *key, n = row.values()
        out[kind][tuple(key)] = n
    return out


def learn(docs: DataFrame, text_col: str) -> FormatModel:
    """The model of all rows, in passes that bring only counts to the driver; it depends on no order, id or partition."""
    texts = docs.select(F.col(text_col).alias("t")).filter("t <> ''").withColumn("half", F.crc32(F.col("t").cast("binary")) % 2)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered((t.as_py(), h.as_py()) for batch in batches for t, h in zip(*batch.columns)):
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.string()), pa.array([t for _, t in part], pa.string()), pa.array(list(part.values()), pa.int64())], names=["kind", "token", "n"])

    counted = texts.mapInArrow(gather, "kind string, token string, n long").groupBy("kind", "token").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "credential-counts")
    halves: tuple[dict[str, int], dict[str, int]] = ({}, {})
    for row in counted.filter(F.col("kind").isin("0", "1")).toArrow().to_pylist():
        halves[int(row["kind"])][row["token"]] = row["n"]
    tokens = counted.filter(F.col("kind").isin(*KINDS[:3]))
    chars = _collected(_by_kind(tokens, lambda _, t: counted_characters(t), "at long, ch string"))
    places = {k: literal_places(c) for k, c in chars.items()}
    automata = public_automata()
    if places:
        sizes = {k: c[-1, ""] for k, c in chars.items()}
        least = F.create_map(*[F.lit(x) for k in sizes for x in (k, max(2.0, sizes[k] / RESOLUTION))])
        nodes = _by_kind(tokens, lambda k, t: counted_nodes(t, places[k]), "node long, parent long, symbol string")
        nodes = materialise(nodes, "credential-nodes")
        often = nodes.filter((F.col("symbol") != "") & (F.col("n") >= least[F.col("kind")]))
        ends = nodes.filter("symbol = ''").join(often.select("kind", "node").union(often.selectExpr("kind", "0L").distinct()), ["kind", "node"], "left_semi")
        trees = _collected(often.unionByName(ends))
        states = {k: merged(frequent(trees.get(k, {}), n)) for k, n in sizes.items()}
        taken = _collected(_by_kind(tokens, lambda k, t: counted_steps(t, places[k], states[k]), "state long, symbol string"))
        automata += [automaton(places[k], states[k], taken[k]) for k in KINDS if k in sizes]

    def high(model: FormatModel, half: int) -> dict[int, int]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = high_ratios((t.as_py() for batch in batches for t in batch.column(0)), model)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["at", "n"])

        found = texts.filter(F.col("half") == half).select("t").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
        return {r["at"]: r["n"] for r in found.collect()}

    return fitted(automata, halves, high)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, spans array of (start, end, kind)) of every row, formats learned from all of them."""
    bounded_batches(docs.sparkSession)
    model = learn(docs, text_col)
    kind = dict(docs.dtypes)[id_col]
    field = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                spans = []
                for x in part.column(1):
                    text = x.as_py() or ""
                    base = base_spans(text)
                    every = sorted(base + model.spans(text, base), key=lambda s: (s[0], KINDS.index(s[2])))
                    spans.append([dict(start=p, end=q, kind=k) for p, q, k in every])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(spans, pa.list_(field))], names=[id_col, text_col, "spans"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, `{text_col}` string, spans array<struct<start: long, end: long, kind: string>>")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans): the scan's spans as counts and text."""
    found = scan(docs, id_col, text_col)
    base = F.filter("spans", lambda s: s["kind"] != "format")

    def written(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [counted(k) for k in KINDS]
    return found.select(id_col, *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """The same columns, each found span replaced by `mark` and the character count (where there is one) brought up to date."""
    bounded_batches(docs.sparkSession)
    model = learn(docs, text_col)
    names = docs.columns
    at, count_at = names.index(text_col), names.index(chars_col) if chars_col in names else -1

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        base = base_spans(text)
        spans = sorted(base + model.spans(text, base))
        out, pos = [], 0
        for a, b, _ in spans:
            if a >= pos:
                out += [text[pos:a], mark]
            pos = max(pos, b)
        return "".join([*out, text[pos:]]) if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                texts = part.column(at).to_pylist()
                cleaned = [clean(t) for t in texts]
                columns = list(part.columns)
                columns[at] = pa.array(cleaned, pa.string())
                if count_at >= 0:
                    old = part.column(count_at).to_pylist()
                    columns[count_at] = pa.array([n if t is c else len(c) for n, t, c in zip(old, texts, cleaned)], part.column(count_at).type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
