"""Probabilistic automata from examples, by merging compatible states.

Examples form a prefix tree, grown level by level. A node is a set of positions in
examples, of which only tallies are needed, so examples may lie anywhere; what follows them are its statistics: the share that ends, the share of
each next character, the classes of the characters after that, and how much is
left. A node with enough examples is merged into a state of its own level, or else
of an earlier one, if all these agree within Hoeffding bounds; otherwise it becomes
a state. What few examples pass proves nothing either way: such nodes of a level are
pooled by the class of the character that leads there, those after one state by
themselves if they are enough, and pools are merged like nodes. So prefixes and lengths that examples share stay in the automaton as chains,
and only what repeats becomes a loop."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

ALPHABET = 68  # characters a credential may hold, and its end
UNSEEN = 0.03  # the share of probability left for characters a state never saw
ALPHA = 0.05
EVIDENCE = 12  # examples that must pass a node before it is compared alone
LOOP = 4  # times as many, on both sides, make a loop
AHEAD = 6  # positions whose classes are compared
UNIT = 1 << 20  # the weight of one whole example; weights are integers, so sums are exact
DEPTH = 256  # levels; what lies beyond is learned with one state per class of character
POOLED = 20.0  # examples' worth of belief in classes over single characters

LOWER, UPPER, DIGIT = "a", "A", "0"
_CLASS = {c: LOWER for c in "abcdefghijklmnopqrstuvwxyz"} | {c: UPPER for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {
    c: DIGIT for c in "0123456789"}
_SIZE = {LOWER: 26, UPPER: 26, DIGIT: 10}


def class_of(character: str) -> str:
    """Lower case, upper case, digits; every other character is a class of its own."""
    return _CLASS.get(character, character)


class Tally:
    """What follows a set of positions in examples, each with its weight; tallies of
    parts of the examples add up, in any order, to that of all."""

    def __init__(self):
        self.n = 0
        self.shares: list[Counter] = [Counter() for _ in range(AHEAD + 2)]  # next, left, classes ahead

    def add(self, text: str, at: int, weight: int = UNIT) -> None:
        self.n += weight
        following, left, *ahead = self.shares
        following[text[at:at + 1]] += weight
        left[len(text) - at] += weight
        for i, share in enumerate(ahead, at):
            share[class_of(text[i]) if i < len(text) else ""] += weight

    def merge(self, other: Tally) -> None:
        self.merge_parts(other.n, other.shares)

    def merge_parts(self, n: int, shares: list[dict]) -> None:
        self.n += n
        for mine, share in zip(self.shares, shares, strict=True):
            for key, weight in share.items():
                mine[key] += weight

    def agrees(self, other: Tally, bound: float) -> bool:
        n, m = self.n, other.n
        most = bound * (1 / math.sqrt(n / UNIT) + 1 / math.sqrt(m / UNIT))
        following, left, *ahead = zip(self.shares, other.shares, strict=True)
        if any(abs(a[key] / n - b[key] / m) > most for a, b in (following, *ahead) for key in a.keys() | b.keys()):
            return False
        gap = 0.0  # lengths are compared by how many are at most so long
        for length in sorted(left[0].keys() | left[1].keys()):
            gap += left[0][length] / n - left[1][length] / m
            if abs(gap) > most:
                return False
        return True


class _Node(Tally):
    """A state: what follows it, and where it leads."""

    def __init__(self):
        super().__init__()
        self.next: dict[str, int] = {}
        self.pools: dict[str, int] = {}  # where the rare characters of a class lead


class Automaton:
    """States with a log-probability and a next state per character; for others of
    a class that a state knows, one per class; and for those of other classes one
    per class of the whole automaton, its state most often entered that way."""

    def __init__(self, steps: list[dict[str, tuple[float, int]]], classes: list[dict[str, tuple[float, int]]],
                 ends: list[float], anywhere: dict[str, tuple[float, int]]):
        self.steps, self.classes, self.ends, self.anywhere = steps, classes, ends, anywhere
        self.unseen = math.log(UNSEEN / ALPHABET)

    def log_likelihood(self, text: str) -> float:
        """Of a whole string, its end included."""
        total, at = 0.0, 0
        for character in text:
            kind = class_of(character)
            step = self.steps[at].get(character) or self.classes[at].get(kind) or self.anywhere.get(kind)
            if step is None:
                total += self.unseen
            else:
                total, at = total + step[0], step[1]
        return total + self.ends[at]


class Builder:
    """States grown level by level from tallies, wherever these were made: `root`
    takes that of all examples, then `level` those of each (state, next character) at
    which examples are, until none goes on or `DEPTH` is reached; `tail` takes what
    lies beyond."""

    def __init__(self, alpha: float = ALPHA, evidence: int = EVIDENCE):
        self.bound, self.evidence = math.sqrt(0.5 * math.log(2 / alpha)), evidence * UNIT
        self.states = [_Node()]

    def root(self, tally: Tally) -> None:
        self.states[0].merge(tally)

    def level(self, groups: dict[tuple[int, str], Tally]) -> None:
        states, evidence = self.states, self.evidence
        level: list[int] = []  # states that are new in this level
        open_: list[tuple[list, Tally, bool]] = []  # (edges, positions, pooled)
        few: dict[tuple[int, str], tuple[list, Tally]] = {}
        for edge in sorted(groups):
            state, character = edge
            if character in states[state].next:  # positions follow the way there is
                states[states[state].next[character]].merge(groups[edge])
            elif groups[edge].n >= evidence:
                open_.append(([edge], groups[edge], False))
            else:
                edges, tally = few.setdefault((state, class_of(character)), ([], Tally()))
                edges.append(edge)
                tally.merge(groups[edge])
        # A node's own pool of a class, or that of all nodes whose pools are small.
        rest: dict[str, tuple[list, Tally]] = {}
        for (_, kind), (edges, tally) in few.items():
            if tally.n >= evidence:
                open_.append((edges, tally, True))
            else:
                pool = rest.setdefault(kind, ([], Tally()))
                pool[0].extend(edges)
                pool[1].merge(tally)
        open_ += [(edges, tally, True) for edges, tally in rest.values()]
        for edges, tally, pooled in sorted(open_, key=lambda group: -group[1].n):
            older = range(min(level, default=len(states)) - 1, -1, -1) if tally.n >= LOOP * evidence else ()
            known = [*level, *(s for s in older if states[s].n >= LOOP * evidence)]
            match = next((s for s in known if tally.agrees(states[s], self.bound)), None)
            if match is None:
                match = len(states)
                states.append(_Node())
                level.append(match)
            states[match].merge(tally)
            for state, character in edges:
                states[state].next[character] = match
                if pooled:
                    states[state].pools[class_of(character)] = match

    def ways(self) -> list[dict[str, int]]:
        """Per state, where each character leads."""
        return [state.next for state in self.states]

    def tail(self, steps: dict[tuple[int | str, str, str], int]) -> None:
        """The weights of all steps beyond `DEPTH`, as `tail_steps` gives them."""
        at: dict[str, int] = {}
        for key in sorted({key for start, c, _ in steps for key in (start, class_of(c)) if isinstance(key, str)}):
            at[key] = len(self.states)
            self.states.append(_Node())
        ways = [dict(way) for way in self.ways()]
        for (start, character, after), weight in steps.items():
            start = at.get(start, start)
            target = ways[start].get(character, at.get(class_of(character)))
            self.states[start].next[character] = target
            self.states[target].n += weight
            self.states[target].shares[0][after] += weight

    def automaton(self) -> Automaton:
        return _probabilities(self.states)


def place(ways: list[dict[str, int]], text: str, depth: int) -> int:
    """The state that the first ``depth`` characters of an example lead to."""
    state = 0
    for character in text[:depth]:
        state = ways[state][character]
    return state


def tail_steps(ways: list[dict[str, int]], text: str) -> Iterator[tuple[int | str, str, str]]:
    """(state, character, the one after it) of an example's characters beyond
    `DEPTH`. Where no way is known there is one state for each class of character."""
    state: int | str = place(ways, text, DEPTH)
    for i in range(DEPTH, len(text)):
        yield state, text[i], text[i + 1:i + 2]
        state = (ways[state] if isinstance(state, int) else {}).get(text[i], class_of(text[i]))


def infer(examples: list[str], alpha: float = ALPHA, evidence: int = EVIDENCE) -> Automaton:
    """The automaton of examples that are few enough for one machine."""
    builder = Builder(alpha, evidence)
    root = Tally()
    for text in examples:
        root.add(text, 0)
    builder.root(root)
    return finish(builder, [(text, UNIT) for text in examples], 0)


def finish(builder: Builder, examples: list[tuple[str, int]], depth: int) -> Automaton:
    """The automaton, given all (example, weight) that go on after ``depth`` levels."""
    living = [(text, weight, place(builder.ways(), text, depth)) for text, weight in examples]
    for at in range(depth, DEPTH):
        living = [item for item in living if at < len(item[0])]
        if not living:
            return builder.automaton()
        groups: dict[tuple[int, str], Tally] = defaultdict(Tally)
        for text, weight, state in living:
            groups[state, text[at]].add(text, at + 1, weight)
        builder.level(groups)
        living = [(text, weight, builder.states[state].next[text[at]]) for text, weight, state in living]
    steps: Counter = Counter()
    for text, weight, _ in living:
        for step in tail_steps(builder.ways(), text):
            steps[step] += weight
    builder.tail(steps)
    return builder.automaton()


def _probabilities(states: list[_Node]) -> Automaton:
    steps, classes, ends, entered = [], [], [], defaultdict(Counter)
    for state in states:
        n, following = state.n, state.shares[0]
        trust = n / (n + POOLED * UNIT)
        by_class, ways = Counter(), defaultdict(Counter)
        for character, target in state.next.items():
            by_class[class_of(character)] += following[character]
            ways[class_of(character)][target] += following[character]
            entered[class_of(character)][target] += following[character]
        pooled = {c: (1 - trust) * k / (n * _SIZE.get(c, 1)) for c, k in by_class.items()}
        log = lambda share: math.log((1 - UNSEEN) * share + UNSEEN / ALPHABET)
        steps.append({c: (log(trust * following[c] / n + pooled[class_of(c)]), target) for c, target in state.next.items()})
        classes.append({c: (log(pooled[c]), state.pools.get(c, ways[c].most_common(1)[0][0])) for c in by_class})
        ends.append(log(following[""] / n if n else 0.0))
    total = sum(sum(targets.values()) for targets in entered.values())
    return Automaton(steps, classes, ends, {
        c: (math.log(UNSEEN * (targets.total() / total / _SIZE.get(c, 1) + 1 / ALPHABET) / 2), targets.most_common(1)[0][0])
        for c, targets in entered.items()})
