"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens; pieces are packed into as
few sequences as possible. Full pieces are sequences already. The others are
dealt at random into blocks of about ``block`` pieces, and each block is solved by
several islands:

* an individual is a grouping of the block's pieces into sequences; an island
  starts with several, from best-fit decreasing and from disturbed orders;
* crossover injects well-filled sequences of one parent whole into the other,
  removes every sequence there that holds a duplicate, and refills: sequences
  with room exchange a piece for a displaced one that fills them better, and
  what is still displaced is best-fitted, longest first;
* after each epoch the best individual of an island migrates to the next one.

An island that reaches the lower bound stops after its first generation. Islands
and blocks are rows, so an epoch is one map over them and a migration one join.
The poorly filled sequences of all blocks are opened again and their pieces packed
in another, smaller round, until they fit one block: what blocks waste at their
ends does not add up."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from daypanel.llm import common
from daypanel.llm.tokens import VOCABULARY, Encoder

CAPACITY = 4096
END_ID = 1
BLOCK = 16_384
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 2, 2, 30, 4
WELL_FILLED = 15 / 16


def token_pieces(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each document's ids with
    ``end_id`` after them, cut only where they exceed ``capacity``. A null or
    empty text is the end id alone. Rows that repeat an id are cut one by one."""
    common.ship()
    common.bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, step = Encoder(vocabulary), end_id.to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            rows = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.packed(content.as_py()) + end
                for at in range(0, len(ids), step):
                    part = ids[at:at + step]
                    rows.append((name, at // step, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType),
                           T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    return docs.select(F.col(doc_id), common.whole(text).cast("binary")).mapInArrow(cut, schema)


# ---- one block ---------------------------------------------------------------

class _Open:
    """Open sequences by the room left; a bit is set for each room there is."""

    def __init__(self, capacity: int):
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0

    def put(self, bin_: int, room: int) -> None:
        self.by_room[room].append(bin_)
        self.rooms |= 1 << room

    def best(self, length: int) -> tuple[int, int] | None:
        """The sequence with the least room that is enough, taken out."""
        enough = self.rooms >> length
        if not enough:
            return None
        room = length + (enough & -enough).bit_length() - 1
        bin_ = self.by_room[room].pop()
        if not self.by_room[room]:
            self.rooms ^= 1 << room
        return bin_, room


def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Places the pieces of ``order`` into the sequences of ``bins`` (-1: none
    yet) or new ones; returns sequences numbered from 0 without gaps."""
    placed = bins >= 0
    n = int(bins[placed].max()) + 1 if placed.any() else 0
    filled = np.bincount(bins[placed], weights=lengths[placed], minlength=n).astype(np.int64)
    opened = _Open(capacity)
    for bin_ in np.flatnonzero((filled > 0) & (filled < capacity)).tolist():
        opened.put(bin_, capacity - int(filled[bin_]))
    chosen = []
    for length in lengths[order].tolist():
        found = opened.best(length)
        bin_, room = found if found else (n, capacity)
        n += not found
        if room > length:
            opened.put(bin_, room - length)
        chosen.append(bin_)
    bins = bins.copy()
    bins[order] = chosen
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then fuller ones: the mean square of their fill."""
    filled = np.bincount(bins, weights=lengths)
    return -len(filled), float(np.mean((filled / capacity) ** 2)) if len(filled) else 0.0


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer sequences. Beyond the total, for any k: pieces over
    capacity - k each need one of their own, those over half need one each, and
    what is left of the latter takes the pieces of at least k."""
    best = -(-int(lengths.sum()) // capacity)
    counts = np.bincount(lengths, minlength=capacity + 1)
    total = counts * np.arange(capacity + 1)
    n_to, sum_to = np.cumsum(counts), np.cumsum(total)
    half = capacity // 2
    for k in range(1, half + 1):
        alone = n_to[-1] - n_to[capacity - k]
        large = n_to[capacity - k] - n_to[half]
        room = large * capacity - (sum_to[capacity - k] - sum_to[half])
        small = sum_to[half] - sum_to[k - 1]
        best = max(best, int(alone + large + max(0, -(-(small - room) // capacity))))
    return best


def refill(lengths: np.ndarray, bins: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Places the displaced pieces (-1). Each sequence with room, in random order,
    takes in or exchanges pieces as long as one of its own can give way to a longer
    displaced one that fits, the largest gain first; the rest is best-fitted."""
    bins = bins.copy()
    out = np.flatnonzero(bins < 0)
    out = out[np.argsort(lengths[out], kind="stable")]
    free, ids = lengths[out].tolist(), out.tolist()  # displaced pieces, shortest first
    placed = np.flatnonzero(bins >= 0)
    placed = placed[np.argsort(bins[placed], kind="stable")]
    groups = np.split(placed, np.flatnonzero(np.diff(bins[placed])) + 1) if len(placed) else []
    for number in rng.permutation(len(groups)).tolist():
        members = groups[number].tolist()
        own = [int(lengths[i]) for i in members]
        room, bin_ = capacity - sum(own), int(bins[members[0]])
        while room > 0 and free:
            gain, leaving, coming = 0, -1, bisect_right(free, room) - 1
            if coming >= 0:
                gain = free[coming]
            for place, length in enumerate(own):
                at = bisect_right(free, length + room) - 1
                if at >= 0 and free[at] - length > gain:
                    gain, leaving, coming = free[at] - length, place, at
            if not gain:
                break
            length, piece = free.pop(coming), ids.pop(coming)
            bins[piece] = bin_
            if leaving < 0:
                members.append(piece)
                own.append(length)
            else:
                bins[members[leaving]] = -1
                at = bisect_right(free, own[leaving])
                free.insert(at, own[leaving])
                ids.insert(at, members[leaving])
                members[leaving], own[leaving] = piece, length
            room -= gain
    left = np.array(ids[::-1], np.int64)
    return best_fit(lengths, left, bins, capacity)


def crossover(lengths: np.ndarray, mother: np.ndarray, father: np.ndarray, capacity: int,
              rng: np.random.Generator) -> np.ndarray:
    """The mother, with some of the father's well-filled sequences whole."""
    filled = np.bincount(father, weights=lengths)
    well = np.flatnonzero(filled >= np.quantile(filled, 0.5))
    injected = rng.choice(well, max(1, int(len(well) * rng.uniform(0.1, 0.5))), replace=False)
    whole = np.isin(father, injected)
    hit = np.zeros(int(mother.max()) + 1, bool)
    hit[mother[whole]] = True
    # A few of the worst sequences are opened too; without that, two good
    # parents would only exchange what both have.
    left = np.bincount(mother, weights=lengths)
    hit[np.argsort(left)[:max(2, len(left) // 20)]] = True
    child = np.where(hit[mother], -1, mother)
    child[whole] = father[whole] + len(hit)
    return refill(lengths, child, capacity, rng)


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int, size: int,
           rng: np.random.Generator) -> list[np.ndarray]:
    """Some generations of one island, best first. An empty population starts
    from best-fit decreasing and from the same with ever more disturbed orders. At
    the lower bound one generation is enough."""
    nothing, bound = np.full(len(lengths), -1, np.int32), lower_bound(lengths, capacity)
    score = lambda bins: fitness(lengths, bins, capacity)
    while len(population) < size:
        spread = 0.1 * len(population)
        keys = lengths * rng.uniform(1 - spread, 1.0, len(lengths))
        population = [*population, best_fit(lengths, np.argsort(-keys, kind="stable"), nothing, capacity)]
    population = sorted(population, key=score, reverse=True)
    for number in range(generations):
        if len(population) < 2 or number and -score(population[0])[0] <= bound:
            break
        a, b = rng.choice(len(population), 2, replace=False)
        children = [crossover(lengths, population[a], population[b], capacity, rng),
                    crossover(lengths, population[0], population[rng.integers(1, len(population))], capacity, rng)]
        population = sorted([*population, *children], key=score, reverse=True)[:size]
    return population[:size]


# ---- all blocks --------------------------------------------------------------

_STATE = "block long, island int, lengths array<int>, population array<array<int>>, sequences int, fullness double"


def _epoch(islands: DataFrame, capacity: int, generations: int, size: int, seed: int, number: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, island, lengths, population, migrant = (batch.column(i)[row] for i in range(5))
                block, island = block.as_py(), island.as_py()
                lengths = lengths.values.to_numpy(zero_copy_only=False).astype(np.int64)
                members = [p.values.to_numpy(zero_copy_only=False) for p in population]
                if migrant.is_valid:
                    members.append(migrant.values.to_numpy(zero_copy_only=False))
                rng = np.random.default_rng([seed, number, block, island])
                members = evolve(lengths, members, capacity, generations, size, rng)
                best = fitness(lengths, members[0], capacity)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([island], pa.int32()),
                     pa.array([lengths], pa.list_(pa.int32())), pa.array([members], pa.list_(pa.list_(pa.int32()))),
                     pa.array([-best[0]], pa.int32()), pa.array([best[1]], pa.float64())],
                    ["block", "island", "lengths", "population", "sequences", "fullness"])

    return islands.select("block", "island", "lengths", "population", "migrant").mapInArrow(run, _STATE)


def _solved(small: DataFrame, n_blocks: int, round_: int, capacity: int, islands: int, epochs: int, generations: int,
            population: int, seed: int) -> DataFrame:
    """(uid, sequence, offset, fill) of pieces (uid, length), packed block by block.
    ``fill`` is that of the piece's whole sequence."""
    dealt = small.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(n_blocks)))
    dealt = dealt.withColumn("i", F.row_number().over(Window.partitionBy("block").orderBy(F.col("length").desc(), "uid")) - 1)
    state = (dealt.groupBy("block")
             .agg(F.sort_array(F.collect_list(F.struct("i", F.col("length").cast("int").alias("l")))).alias("items"))
             .select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                     F.col("items.l").alias("lengths"),
                     F.array().cast("array<array<int>>").alias("population"),
                     F.lit(None).cast("array<int>").alias("migrant"))
             .repartition(min(n_blocks * islands, 4096), "block", "island"))
    for number in range(epochs):
        state = common.durable(_epoch(state, capacity, generations, population, seed, number + round_ * epochs))
        if number + 1 < epochs:
            elite = state.select(F.col("block").alias("b"), ((F.col("island") + 1) % islands).alias("i"),
                                 F.col("population")[0].alias("migrant"))
            state = state.join(elite, (F.col("block") == F.col("b")) & (F.col("island") == F.col("i")))
    best = (state.groupBy("block").agg(F.min_by(
        F.struct("lengths", F.col("population")[0].alias("bins")),
        F.struct("sequences", -F.col("fullness"), "island")).alias("best")).select("block", "best.*"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                lengths, bins = (batch.column(i)[row].values.to_numpy(zero_copy_only=False).astype(np.int64)
                                 for i in (1, 2))
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(lengths[order]) - lengths[order]
                first = np.r_[True, np.diff(bins[order]) != 0]
                start = before[first][np.cumsum(first) - 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(order), batch.column(0)[row].as_py(), np.int64)), pa.array(order),
                     pa.array(bins[order]), pa.array(before - start),
                     pa.array(np.bincount(bins, lengths)[bins[order]].astype(np.int64))], ["b", "p", "s", "offset", "fill"])

    places = best.mapInArrow(place, "b long, p long, s long, offset long, fill long")
    # A round has less than 2^24 blocks, a block less than 2^32 sequences.
    sequence = F.lit(round_ << 56) + F.shiftleft("b", 32) + F.col("s")
    return common.durable(dealt.join(places, (F.col("block") == F.col("b")) & (F.col("i") == F.col("p")))
                          .select("uid", "length", sequence.alias("sequence"), "offset", "fill"))


def pack(pieces: DataFrame, *, length: str = "length", capacity: int = CAPACITY, block: int = BLOCK,
         islands: int = ISLANDS, epochs: int = EPOCHS, generations: int = GENERATIONS, population: int = POPULATION,
         seed: int = 7) -> DataFrame:
    """``pieces`` with sequence_id and offset: where each starts in its sequence,
    without gaps from 0, at most ``capacity`` in all.

    Lengths lie between 1 and ``capacity``; a row with any other length, or none,
    gets null for both. Equal lengths, repeated rows and an empty table need no
    care: every row is a piece of its own. Other columns are passed on."""
    common.ship()
    pieces = common.durable(pieces)
    uid, found = common.unused_name(pieces, "uid"), common.unused_name(pieces, "found")
    sequence, offset = common.unused_name(pieces, "sequence"), common.unused_name(pieces, "offset")
    # Row numbers of a written table are fixed, so a retried task deals alike.
    numbered = pieces.withColumn(uid, F.monotonically_increasing_id())
    is_small = F.col(length).between(1, capacity - 1)
    alone = numbered.filter(~is_small | F.col(length).isNull()).withColumns({
        sequence: F.when(F.col(length) == capacity, -1 - F.col(uid)),
        offset: F.when(F.col(length) == capacity, F.lit(0).cast("long"))})
    left = numbered.filter(is_small).select(F.col(uid).alias("uid"), F.col(length).cast("long").alias("length"))
    n_blocks, round_, places = max(1, -(-left.count() // block)), 0, None
    while True:
        solved = _solved(left, n_blocks, round_, capacity, islands, epochs, generations, population, seed)
        poor = solved.filter(F.col("fill") < int(capacity * WELL_FILLED))
        # Another round only where it is smaller: in one block nothing is wasted
        # at the ends of blocks, and pieces that leave much room in every block
        # leave as much in the next.
        fewer = max(1, -(-poor.count() // block))
        more = n_blocks > 1 and fewer < n_blocks
        done = solved.filter(F.col("fill") >= int(capacity * WELL_FILLED)) if more else solved
        places = done if places is None else places.unionByName(done)
        if not more:
            break
        left, n_blocks, round_ = poor.select("uid", "length"), fewer, round_ + 1
    places = places.select(F.col("uid").alias(found), F.col("sequence").alias(sequence), F.col("offset").alias(offset))
    packed = numbered.filter(is_small).join(places, F.col(uid) == F.col(found))
    columns = [*pieces.columns, sequence, offset]
    named = [F.col(f"`{c}`") for c in pieces.columns]
    return (alone.select(columns).unionByName(packed.select(columns))
            .select(*named, F.col(sequence).alias("sequence_id"), F.col(offset).alias("offset")))
