"""Secrets in texts: fixed formats, and formats learned from them.

Matches of the fixed formats in all texts are labelled credentials. All distinct
ones of a kind teach one probabilistic automaton, and half of all other distinct long
tokens one for ordinary text. Nothing is sampled: tasks tally what they hold, level by
level of the automata, and tallies add up. Weights say how much a token counts for:
those of a kind or of a stratum (classes of characters and length) of many tokens
share what a full one may count for, so rare ordinary formats (addresses, dates,
paths) are not drowned by words, and automata stay small however many tokens teach
them. A stratum with a quarter as many labelled
credentials as other tokens is no ordinary one and left out, with tokens that have
a part of it, since what is not labelled there may well be a credential too. Every token that could be a credential, or else the
parts that ``/`` and ``=`` cut it into, is then scored by how much likelier its
format is under a credential automaton than under the ordinary one; all that score
above a threshold found on the other half of the ordinary tokens are reported besides
the fixed matches."""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from daypanel.llm import common
from daypanel.llm.grammar import DEPTH, UNIT, Automaton, Builder, Tally, class_of, finish, place, tail_steps

# The kinds in order, their patterns and the least length of what counts.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are greedy, so shorter ones never count
KEYWORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
LEARNED = "learned"
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")

PART = re.compile(r"[^/=]{12,}")

# What all credentials of a kind, all ordinary tokens and those of a stratum count for at most.
EXAMPLES, LEAST_EXAMPLES, ORDINARY, PER_STRATUM = 300, 20, 20_000, 1_000
MARGIN, ORDINARY_SHARE = 0.5, 0.99
STEP = 0.001  # of the threshold
REMEMBERED = 200_000  # tokens a task remembers, so as to give each about once
FEW, FEW_CHARACTERS = 5_000, 1_000_000  # examples whose last levels are learned in one go
SUSPECT = 0.25  # credentials to other tokens that make a stratum no ordinary one


def fixed_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, credential) of the fixed formats, in order."""
    spans = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        spans += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    spans += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str, spans) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, token, free) of all tokens but those that lie within fixed
    spans; free are those that no fixed span overlaps."""
    at = 0
    ends = []  # fixed spans of different kinds may overlap; merged here
    for start, _, end, _ in spans:
        if ends and start <= ends[-1][1]:
            ends[-1][1] = max(ends[-1][1], end)
        else:
            ends.append([start, end])
    for m in CANDIDATE.finditer(text):
        while at < len(ends) and ends[at][1] <= m.start():
            at += 1
        free = at == len(ends) or ends[at][0] >= m.end()
        if free or not (ends[at][0] <= m.start() and m.end() <= ends[at][1]):
            yield m.start(), m.end(), m[0], free


def parts(start: int, token: str) -> list[tuple[int, int, str]]:
    """(start, end, part) of the parts of a token that could be credentials."""
    if "/" not in token and "=" not in token:
        return []
    return [(start + m.start(), start + m.end(), m[0]) for m in PART.finditer(token) if len(m[0]) < len(token)]


def stratum(token: str) -> str:
    """The classes of a token's characters, and the magnitude of its length."""
    return "".join(sorted(set(map(class_of, token)))) + str(len(token).bit_length())


@dataclass
class Grammar:
    """The automata of credentials and of ordinary tokens, and how much likelier
    per character a credential's format must be."""
    kinds: list[Automaton]
    ordinary: Automaton | None
    threshold: float

    def score(self, token: str) -> float:
        best = max(a.log_likelihood(token) for a in self.kinds)
        return (best - self.ordinary.log_likelihood(token)) / (len(token) + 1)


class Scores(dict):
    """Whether a token passes, kept for tokens seen before."""

    def __init__(self, grammar: Grammar):
        super().__init__()
        self.grammar = grammar

    def __missing__(self, token: str) -> bool:
        found = self.grammar.score(token) > self.grammar.threshold
        if len(self) >= 300_000:
            self.clear()
        if len(token) <= 64:
            self[token] = found
        return found


def tokens(docs: DataFrame, text: str) -> DataFrame:
    """All distinct tokens of the texts, stored: (kind, stratum, inside, value), of
    credentials the kind and no stratum; of others no kind, their stratum and those of
    their parts (``inside``). Besides, per task and stratum, how many credentials and
    others there are, repeats included: the kind says which, ``value`` how many."""
    schema = pa.schema([("kind", pa.string()), ("stratum", pa.string()), ("inside", pa.list_(pa.string())),
                        ("task", pa.int32()), ("value", pa.string())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[str, str]] = set()  # what this task has given already, as far as it remembers
        seen: Counter = Counter()
        for batch in batches:
            rows = []
            for content in batch.column(0):
                content = content.as_py()
                spans = fixed_spans(content)
                for _, kind, _, value in spans:
                    seen["credentials", stratum(value)] += 1
                    if (KINDS[kind], value) not in known:
                        known.add((KINDS[kind], value))
                        rows.append((KINDS[kind], "", [], None, value))
                found = {token for _, _, token, free in candidates(content, spans) if free}
                for token in found | {part for token in found for _, _, part in parts(0, token)}:
                    where = stratum(token)
                    seen["others", where] += 1
                    if ("", token) not in known:
                        known.add(("", token))
                        inside = sorted({stratum(part) for _, _, part in parts(0, token)})
                        rows.append(("", where, inside, None, token))
                if len(known) > REMEMBERED:
                    known.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)],
                                                 schema=schema)
        task = TaskContext.get().partitionId()  # keeps the counts of two tasks apart
        for (kind, where), n in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                ([kind], [where], [[]], [task], [str(n)]), schema.types, strict=True)], schema=schema)

    return common.durable(docs.select(common.whole(text).alias("text")).mapInArrow(
        label, "kind string, stratum string, inside array<string>, task int, value string").distinct())


def learn_automata(lessons: DataFrame, weights: list[dict[str, int]]) -> list[Automaton]:
    """Automata number 0 to n - 1 from all rows (number, stratum, value), each with the
    weight of its stratum. A level is a job in which each task tallies the examples it
    holds; the driver gets tallies, whose size is that of the automata. Once few
    examples go on, these are fetched and the rest is done at once."""
    builders = [Builder() for _ in weights]

    def walk(depth: int):
        ways = [builder.ways() for builder in builders]

        def tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            groups, steps, n, size = defaultdict(Tally), Counter(), 0, 0
            for batch in batches:
                for number, where, value in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    weight = weights[number][where]
                    if depth < 0:
                        groups[number, 0, ""].add(value, 0, weight)
                    elif depth < min(len(value), DEPTH):
                        groups[number, place(ways[number], value, depth), value[depth]].add(value, depth + 1, weight)
                    elif depth < len(value):
                        for step in tail_steps(ways[number], value):
                            steps[number, step] += weight
                    if len(value) > depth + 1:
                        n, size = n + 1, size + len(value)
            plain = {key: (tally.n, [dict(share) for share in tally.shares]) for key, tally in groups.items()}
            found = pickle.dumps((plain, dict(steps), n, size))
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], ["found"])

        groups, steps, n, size = defaultdict(Tally), Counter(), 0, 0
        for row in lessons.mapInArrow(tallies, "found binary").collect():
            more, further, n_more, size_more = pickle.loads(bytes(row.found))
            for key, tally in more.items():
                groups[key].merge_parts(*tally)
            for key, weight in further.items():
                steps[key] += weight
            n, size = n + n_more, size + size_more
        return groups, steps, n, size

    for depth in range(-1, DEPTH + 1):
        groups, steps, n, size = walk(depth)
        for number, builder in enumerate(builders):
            if depth < 0:
                builder.root(groups[number, 0, ""])
            elif depth < DEPTH:
                builder.level({key[1:]: tally for key, tally in groups.items() if key[0] == number})
            else:
                builder.tail({step: weight for (which, step), weight in steps.items() if which == number})
        if n <= FEW and size <= FEW_CHARACTERS and depth < DEPTH:
            rest = [[] for _ in builders]
            for row in lessons.filter(F.length("value") > depth + 1).collect():
                rest[row.number].append((row.value, weights[row.number][row.stratum]))
            return [finish(builder, examples, depth + 1) for builder, examples in zip(builders, rest, strict=True)]
    return [builder.automaton() for builder in builders]


def even_share(sizes: Counter, total: int, most: int) -> dict[str, int]:
    """The weight of a token of each stratum: strata of more tokens than a bound share
    out as many whole ones; the bound is ``most`` or, where that gives more than
    ``total`` in all, lower."""
    bound, left, strata = float(most), float(total), sorted(sizes.values())
    for i, size in enumerate(strata):
        if size * (len(strata) - i) > left:
            bound = min(bound, left / (len(strata) - i))
            break
        left -= size
    return {where: max(1, int(UNIT * min(1.0, bound / n))) for where, n in sizes.items()}


def learn(docs: DataFrame, *, text: str = "text", examples: int = EXAMPLES, ordinary: int = ORDINARY,
          least_examples: int = LEAST_EXAMPLES, per_stratum: int = PER_STRATUM) -> Grammar:
    """Automata from all documents: every text is labelled, and all distinct whole
    credentials of each kind are learned from, together as ``examples`` if they are
    more, and all other tokens, as ``per_stratum`` of each stratum and ``ordinary`` in
    all; half of these set the threshold, but none of a stratum of fewer than
    ``least_examples``: of so few, a half says no more than that their format is rare. A kind with fewer than
    ``least_examples`` distinct credentials in the corpus teaches nothing and gets
    no automaton; without any, or without ordinary tokens, nothing is added to the
    fixed spans."""
    common.ship()
    labelled = tokens(docs, text)
    counts: Counter = Counter()
    for r in labelled.filter(F.col("kind").isin("credentials", "others")).groupBy("kind", "stratum").agg(
            F.sum(F.col("value").cast("long")).alias("n")).collect():  # a row per stratum: some thousands at most
        counts[r.kind, r.stratum] = r.n
    suspect = [where for kind, where in counts if kind == "credentials"
               and counts[kind, where] > 1 and counts[kind, where] >= SUSPECT * counts["others", where]]
    named = F.array(*map(F.lit, suspect)).cast("array<string>")
    plain = labelled.filter((F.col("kind") == "") & ~F.array_contains(named, F.col("stratum")) & ~F.arrays_overlap(named, "inside"))
    strata = Counter({r.stratum: r.n for r in plain.groupBy("stratum").agg(F.count("*").alias("n")).collect()})
    sizes = {r.kind: r.n for r in labelled.filter(F.col("kind").isin(*KINDS)).groupBy("kind").agg(F.count("*").alias("n")).collect()}
    taught = [kind for kind in KINDS if sizes.get(kind, 0) >= least_examples]
    if not taught or strata.total() < 2 * least_examples:
        return Grammar([], None, 0.0)
    share = even_share(strata, ordinary, per_stratum)
    weights = [*(even_share(Counter({"": sizes[kind]}), examples, examples) for kind in taught), share]
    small = F.array(*(F.lit(where) for where, n in strata.items() if n < least_examples)).cast("array<string>")
    teaches = (F.xxhash64("value") % 2 == 0) | F.array_contains(small, F.col("stratum"))
    number = F.coalesce(*(F.when(F.col("kind") == kind, F.lit(i)) for i, kind in enumerate(taught)), F.lit(len(taught)))
    lessons = common.durable(labelled.filter(F.col("kind").isin(*taught)).unionByName(plain.filter(teaches))
                             .select(number.alias("number"), "stratum", "value")
                             .repartition(docs.sparkSession.sparkContext.defaultParallelism, "value"))
    *kinds, everyday = learn_automata(lessons, weights)
    grammar = Grammar(kinds, everyday, MARGIN)
    grammar.threshold = max(MARGIN, held_score(plain.filter(~teaches), grammar, share))
    return grammar


def held_score(held: DataFrame, grammar: Grammar, weights: dict[str, int]) -> float:
    """The score, to the next `STEP`, that `ORDINARY_SHARE` of all held-back tokens by
    weight do not exceed."""
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for where, value in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                found[math.ceil(grammar.score(value) / STEP)] += weights[where]
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())],
                                         ["score", "weight"])

    rows = held.select("stratum", "value").mapInArrow(scores, "score long, weight long").groupBy("score").agg(
        F.sum("weight").alias("weight")).orderBy("score").collect()  # scores are per character: some thousand steps
    left = ORDINARY_SHARE * sum(r.weight for r in rows)
    for r in rows:
        left -= r.weight
        if left < 0:
            return r.score * STEP
    return rows[-1].score * STEP if rows else 0.0


def scan(docs: DataFrame, grammar: Grammar, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id and spans, an array of (kind, start, end,
    learned) by start, then kind as listed, learned ones last. Offsets are code
    points, the end exclusive. Null and empty texts have none; rows that repeat
    an id are scanned one by one; other columns are not read."""
    common.ship()
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = Scores(grammar)
        for batch in batches:
            rows = []
            for content in batch.column(1):
                content = content.as_py()
                fixed = fixed_spans(content)
                spans = [(start, number, end) for start, number, end, _ in fixed]
                if grammar.kinds:
                    for start, end, token, _ in candidates(content, fixed):
                        if passes[token]:
                            spans.append((start, len(KINDS), end))
                        else:
                            inside = [(s, e) for s, _, e, _ in fixed if s < end and start < e]
                            spans += [(low, len(KINDS), high) for low, high, part in parts(start, token)
                                      if passes[part] and not any(s <= low and high <= e for s, e in inside)]
                names = (*KINDS, LEARNED)
                rows.append([{"kind": names[number], "start": start, "end": end}
                             for start, number, end in sorted(spans)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kind))], ["doc_id", "spans"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("spans", T.ArrayType(
        T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                      T.StructField("end", T.LongType())])))])
    return docs.select(F.col(doc_id), common.whole(text)).mapInArrow(work, schema)
