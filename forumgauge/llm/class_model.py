"""Brown class-based bigram language model.

Words are runs of characters other than the space and 0x09-0x0D, A-Z in lower case, and go
by 63-bit hashes; every text ends in one end token.  A word that training texts hold
``LEAST`` times is a unit of its own, whatever the corpus's size; rarer and unseen words form units by
their last two bytes.  Exchange clustering assigns the units to ``CLASSES``
classes: in each pass every unit's best class is found from the corpus's unit bigrams,
and a share of the units move: half, and half as many again after a pass that did not
raise the mutual information of adjacent classes.  The best pass's assignment is kept.

A token's probability is that of its class after the class before, times that of its
unit within the class, times that of the word within its unit, each smoothed: classes by
their overall share, words by half a count and one unknown word per unit.  The base
score is the unigram score with half a count.

Counts cover all training texts.  Words that are units of their own, ``LEXICON`` at most, travel
to the tasks with counts and classes, and rarer ones while there are few words in all; the others are
looked up by joins, as no word among them is frequent.  The driver holds the class bigrams and a byte
for each unit that travels.  The neighbours of every unit are dealt out once, packed in parts, and
each pass reads them where they lie; the most frequent units are in all parts and their counts
are added up.  Only where more than ``LEXICON`` words are units, these and their classes
are tables that meet the unit bigrams in joins in every pass.

Cases: a null or empty text is the end token alone; rows with one key, and those with a
null key, are scored as one document, whose counts and scores are their sums; a null key is
training text; without training texts all counts are zero and scores follow the formulas with
N and V zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumgauge.llm import words
from forumgauge.llm.tables import Work, map_batches

CLASSES = 48
PASSES = 5
LEAST = 5
LEXICON, RARER = 1 << 24, 500_000  # words that travel at most: units of their own, and all if rarer ones travel, too
HEAVY = 4000  # a unit with more than this part of all tokens is in all parts
PART = 1 << 19  # tokens of a part
ROW = 1 << 16  # pairs of a row of a part, where no unit has more
BATCH_BYTES = 1 << 24  # of rows of packed pairs that are handed to a task at once
TOGETHER = 512  # units whose best classes are found at once
CLASS_PRIOR = 5.0
END, OTHER, WORDS, HASHES = 0, (1 << 17) - 1, 1 << 17, 1 << 32  # ids: end token, endings, unseen ones, known and all words
HELD = 2_000_000


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows [first, last): ids and endings of all tokens in a row, and each row's number of tokens.

    Every text ends in one end token.
    """
    for first, last, data, offsets in words.chunks(column):
        starts, ends, row = words.spans(data, offsets)
        code = (words.hashes(data, starts, ends, lower=True) >> np.uint64(1)).astype(np.int64)
        low = data.astype(np.int64)
        low[(low >= ord("A")) & (low <= ord("Z"))] += 32
        tail = low[ends - 1]
        ending = 1 + np.where(ends - starts > 1, low[np.maximum(ends - 2, 0)] << 8 | tail, (1 << 16) + tail)
        bounds = words.row_bounds(row, last - first)
        yield (first, last, np.insert(np.maximum(code, HASHES), bounds[1:], END), np.insert(ending, bounds[1:], END),
               np.diff(bounds) + 1)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType()) for name in names])


def _batch(schema: T.StructType, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=schema.names)


def _tallied(batches: Iterator[tuple[np.ndarray, np.ndarray]], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of numbers and how often each comes, ``HELD`` at a time."""
    pending, held = [], 0

    def flush() -> pa.RecordBatch:
        a, b = (np.concatenate([p[i] for p in pending]) if pending else np.empty(0, np.int64) for i in (0, 1))
        order, starts = _runs(a, b)
        return _batch(schema, a[order[starts]], b[order[starts]], np.diff(np.append(starts, len(a))))

    for pair in batches:
        pending.append(pair)
        held += len(pair[0])
        if held > HELD:
            yield flush()
            pending, held = [], 0
    yield flush()


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows together, and where each run of equal rows begins."""
    code = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        code = words.mix(code + column.astype(np.uint64) + words.GRAM_BASE)
    order = np.argsort(code)
    code = code[order]
    return order, np.flatnonzero(np.concatenate([np.ones(min(1, len(code)), bool), code[1:] != code[:-1]]))


def word_counts(texts: DataFrame) -> DataFrame:
    """word (its id), ending, n over all texts."""
    schema = _longs("word", "ending", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _tallied(((code, ending) for batch in batches for _, _, code, ending, _ in tokens(batch.column(0))), schema)

    return map_batches(texts, run, schema).groupBy("word", "ending").agg(F.sum("n").alias("n"))


class Lexicon:
    """The words that tasks know, with a value each."""

    def __init__(self, ids: np.ndarray, **values: np.ndarray):
        order = np.argsort(ids)
        self.ids = ids[order]
        self.values = {name: value[order] for name, value in values.items()}

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word is, and whether it is there."""
        at = np.minimum(np.searchsorted(self.ids, code), len(self.ids) - 1)
        return at, self.ids[at] == code


class Units:
    """The table of units (unit, n, types), and of each word that has one (word, n, unit).

    ``known`` are the words that travel to the tasks, units of their own first, and the end token, ``rare`` all others;
    ``complete`` says that no rare word is a unit of its own.  Ids of units below ``HASHES``, endings and
    known words, are bounded in number; those of known words follow their frequency.
    """

    def __init__(self, counts: DataFrame, work: Work):
        spark = counts.sparkSession
        total, self.vocabulary = counts.agg(F.sum("n"), F.count("*")).first()
        self.total = total or 0
        level = F.floor(F.log2("n") * 4)
        cut, held = 1 << 10, 0
        for row in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
            held += row["count"]
            if held > (LEXICON if row["level"] >= int(4 * np.log2(LEAST)) else min(LEXICON, RARER)):
                break
            cut = row["level"]
        listed = (F.col("word") == END) | (level >= cut)
        found = counts.where(listed).toArrow()
        word, ending, n = (found[c].to_numpy() for c in ("word", "ending", "n"))
        if END not in word:
            word, ending, n = (np.append(x, 0) for x in (word, ending, n))
        order = np.lexsort((word, -n))
        word, ending, n = word[order], ending[order], n[order]
        unit = np.where(word == END, END, np.where(n >= LEAST, WORDS + np.arange(len(word)), ending))
        self.size = WORDS + len(word)  # ids of units that travel are below
        self.lexicon = Lexicon(word, unit=unit.astype(np.int32))
        self.known = work.keep(spark.createDataFrame(pa.table({"word": word, "n": n, "unit": unit})), "known")
        own = F.col("n") >= LEAST
        self.rare = counts.where(~listed).select("word", "n", F.when(own, F.col("word")).otherwise(F.col("ending")).alias("unit"))
        self.complete = not self.rare.where(own).take(1)
        of = self.known.unionByName(self.rare)
        alone = (F.col("unit") == END) | (F.col("unit") >= WORDS)
        endings = of.where(~alone).groupBy("unit").agg(F.sum("n").alias("n"), F.count("*").alias("types"))
        table = (of.where(alone).select("unit", "n", F.lit(1).cast("bigint").alias("types")).unionByName(endings)
                 .unionByName(spark.createDataFrame([(OTHER, 0, 0)], _longs("unit", "n", "types"))))
        self.table = work.keep(table, "units")


def _spread(*columns: str) -> Column:
    """A key that meets no unit or word, and differs from row to row."""
    return -1 - F.pmod(F.xxhash64(*columns), F.lit(1 << 50))


def _adjacent(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, complete: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Adjacent units of texts, with an end before each; without ``complete``, words that the lexicon lacks are negative."""
    for batch in batches:
        for _, _, code, ending, _ in tokens(batch.column(0)):
            at, known = lexicon.find(code)
            line = np.append(END, np.where(known, lexicon.values["unit"][at], ending if complete else -code))
            yield line[:-1], line[1:]


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers below 2**32, byte by byte, so that like bytes lie side by side and compress."""
    return np.stack(columns).astype("<u4").view(np.uint8).reshape(len(columns), -1, 4).transpose(0, 2, 1).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    """The columns unit, neighbour and times."""
    planes = np.frombuffer(data, np.uint8).reshape(3, 4, -1).transpose(0, 2, 1)
    return np.ascontiguousarray(planes).view("<u4")[:, :, 0].astype(np.int64)


def _merged(unit: np.ndarray, other: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
    """Distinct pairs in order, and how often each comes."""
    code = unit << 32 | other
    if times is None:
        code.sort()
    else:
        order = np.argsort(code)
        code, times = code[order], times[order]
    starts = np.flatnonzero(np.append(True, code[1:] != code[:-1])[:len(code)])
    n = np.diff(np.append(starts, len(code))) if times is None else np.add.reduceat(times, starts) if len(starts) else times
    return np.stack([code[starts] >> 32, code[starts] & 0xFFFFFFFF, n])


def neighbours(texts: DataFrame, units: Units, heavy: np.ndarray, work: Work) -> DataFrame:
    """after, before: for the units of a part, packed, what comes after and before each and how often.

    A unit is in one part, but for the heavy ones, whose neighbours are spread over all.  Pairs of a unit with itself
    are in ``after`` alone.  For complete units.
    """
    parts = max(16, units.total // PART)
    shared = texts.sparkSession.sparkContext.broadcast(units.lexicon)
    dealt = T.StructType([*_longs("part", "side"), T.StructField("pairs", T.BinaryType())])
    merged = T.StructType([T.StructField(name, T.BinaryType()) for name in ("after", "before")])

    def rows(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        pairs = _merged(u, v)
        out = []
        for side in (0, 1):
            if side:
                pairs = pairs[[1, 0, 2]][:, pairs[0] != pairs[1]]
                pairs = pairs[:, np.argsort(pairs[0], kind="stable")]
            spread = pairs[0] + np.where(np.isin(pairs[0], heavy), pairs[1], 0)
            part = (words.mix(spread.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange(parts + 1))
            ordered = pairs[:, order]
            out += [(p, side, _packed(*ordered[:, a:b])) for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(
            (pa.int64(), pa.int64(), pa.binary()))], names=dealt.names)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, held = [], 0
        for pair in _adjacent(batches, shared.value, True):
            pending.append(pair)
            held += len(pair[0])
            if held > HELD // 2:
                yield rows(*(np.concatenate(x) for x in zip(*pending)))
                pending, held = [], 0
        if pending:
            yield rows(*(np.concatenate(x) for x in zip(*pending)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut(blocks: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            sides = [_merged(*np.concatenate([np.empty((3, 0), np.int64), *side], 1)) for side in blocks]
            firsts = np.unique(np.sort(np.concatenate([side[0] for side in sides]))[::ROW])
            bounds = [np.append(np.searchsorted(side[0], firsts), side.shape[1]) for side in sides]
            for i in range(len(firsts)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_packed(*side[:, at[i]:at[i + 1]])], pa.binary()) for side, at in zip(sides, bounds)],
                    names=merged.names)

        now, blocks = None, [[], []]
        for batch in batches:
            for part, side, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if part != now and now is not None:
                    yield from cut(blocks)
                    blocks = [[], []]
                now = part
                blocks[side].append(_unpacked(pairs.as_buffer()))
        if now is not None:
            yield from cut(blocks)

    table = map_batches(texts, deal, dealt).repartition(parts, "part").sortWithinPartitions("part")
    return work.keep(map_batches(table, merge, merged), "neighbours")


def unit_bigrams(texts: DataFrame, units: Units, work: Work) -> DataFrame:
    """u, v, n: adjacent units of all texts, with an end before each text.

    Tasks know the units of frequent words, and of all others if these have none of their own;
    otherwise the others are negative until they get theirs by a join.
    """
    complete = units.complete
    shared = texts.sparkSession.sparkContext.broadcast(units.lexicon)
    schema = _longs("u", "v", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _tallied(_adjacent(batches, shared.value, complete), schema)

    pairs = map_batches(texts, run, schema)
    if not complete:
        pairs = work.keep(pairs, "pairs")
        rest = pairs.where("u < 0 or v < 0")
        for x in "uv":
            rare = units.rare.select(F.col("word").alias("_word"), F.col("unit").alias("_unit"))
            key = F.when(F.col(x) < 0, -F.col(x)).otherwise(_spread("u", "v"))
            rest = (rest.withColumn("_key", key).join(rare, F.col("_key") == F.col("_word"), "left")
                    .withColumn(x, F.coalesce("_unit", x)).select("u", "v", "n"))
        pairs = pairs.where("u >= 0 and v >= 0").unionByName(rest)
    return pairs.groupBy("u", "v").agg(F.sum("n").alias("n"))


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def information(grid: np.ndarray) -> float:
    """The part of the class bigrams' log-likelihood that depends on the classes."""
    return float(_phi(grid).sum() - _phi(grid.sum(0)).sum() - _phi(grid.sum(1)).sum())


def best_class(grid: np.ndarray, own: int, after: np.ndarray, before: np.ndarray, self_pairs: float) -> int:
    """The class to which a unit fits best, see ``best_classes``."""
    return int(best_classes(grid, np.array([own]), after[None, :], before[None, :], np.array([float(self_pairs)]))[0])


def best_classes(grid: np.ndarray, own: np.ndarray, after: np.ndarray, before: np.ndarray, self_pairs: np.ndarray) -> np.ndarray:
    """The class to which each unit fits best.

    ``after`` and ``before`` count the classes that follow and precede the units, themselves
    left out.  Each unit is taken out of its class and tried in each, the others staying
    where they are.  Only classes that a unit has for neighbours change its sums.
    """
    units, classes = np.arange(len(own)), np.arange(len(grid))
    gain = np.zeros((len(own), len(grid)))
    for table, mine, theirs in ((grid.T, after, before), (grid, before, after)):
        unit, d = np.nonzero(mine)
        left, step = table[d], mine[unit, d]  # over classes c: what meets d there without the unit
        left[np.arange(len(unit)), own[unit]] -= step
        same = d == own[unit]
        left[same] -= theirs[unit[same]]
        left[same, own[unit[same]]] -= self_pairs[unit[same]]
        left = np.maximum(left, 0)
        moved, first = np.unique(unit, return_index=True)
        if len(moved):
            gain[moved] += np.add.reduceat(_phi(left + step[:, None]) - _phi(left), first, axis=0)
    corner = np.broadcast_to(np.diag(grid), gain.shape).copy()
    corner[units, own] -= after[units, own] + before[units, own] + self_pairs
    corner, self_pairs = np.maximum(corner, 0), self_pairs[:, None]
    gain += (_phi(corner + after + before + self_pairs) - _phi(corner + after) - _phi(corner + before) + _phi(corner))
    here = classes[None, :] == own[:, None]  # wherever the unit goes, its neighbours meet it
    for margin, side in ((grid.sum(1), after), (grid.sum(0), before)):
        total = side.sum(1, keepdims=True) + self_pairs
        rest = np.maximum(margin[None, :] - here * total, 0)
        gain -= _phi(rest + total) - _phi(rest)
    return gain.argmax(1)


def _start(units: Units, classes: int) -> DataFrame:
    """unit, c: known words by rank, the others by hash."""
    known = (F.col("unit") >= WORDS) & (F.col("unit") < HASHES)
    return units.table.select("unit", F.when(known, F.col("unit") - WORDS).otherwise(
        F.pmod(F.xxhash64("unit"), F.lit(classes))).alias("c")).withColumn("c", F.col("c") % classes)


def _classed(pairs: DataFrame, assigned: DataFrame, complete: bool) -> DataFrame:
    """Pairs u, v, n with the classes cu, cv: known units travel to the pairs, the others meet them by a join."""
    known = assigned.where(F.col("unit") < HASHES)
    for x in "uv":
        pairs = pairs.join(F.broadcast(known.select(F.col("unit").alias(x), F.col("c").alias(f"c{x}"))), x, "left")
    if complete:
        return pairs
    rest, rare = pairs.where("cu is null or cv is null"), assigned.where(F.col("unit") >= HASHES)
    for x in "uv":
        side = rare.select(F.col("unit").alias("_unit"), F.col("c").alias("_c"))
        key = F.when(F.col(f"c{x}").isNull(), F.col(x)).otherwise(_spread("u", "v"))
        rest = (rest.withColumn("_key", key).join(side, F.col("_key") == F.col("_unit"), "left")
                .withColumn(f"c{x}", F.coalesce(f"c{x}", "_c")).drop("_key", "_unit", "_c"))
    return pairs.where("cu is not null and cv is not null").unionByName(rest)


def _moves(around: DataFrame, grid: np.ndarray) -> DataFrame:
    """unit, to: the best class of each unit, from its rows unit, own, side, c, n."""
    shared = around.sparkSession.sparkContext.broadcast(grid)
    schema = _longs("unit", "to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = shared.value

        def moved(rows: np.ndarray) -> pa.RecordBatch:
            unit, first, at = np.unique(rows[0], return_index=True, return_inverse=True)
            sides = np.zeros((3, len(unit), len(grid)))
            np.add.at(sides, (rows[2], at, rows[3]), rows[4])
            own = rows[1][first]
            to = best_classes(grid, own, sides[0], sides[1], sides[2].sum(1)) if len(unit) else own
            return _batch(schema, unit, to)

        pending = [np.empty((5, 0), np.int64)]
        for batch in batches:
            pending.append(np.array([c.to_numpy() for c in batch.columns], np.int64).reshape(5, -1))
            if sum(p.shape[1] for p in pending) > 20_000:
                rows = np.concatenate(pending, 1)
                whole = int(np.flatnonzero(rows[0] == rows[0][-1])[0])  # the last unit may go on
                yield moved(rows[:, :whole])
                pending = [rows[:, whole:]]
        yield moved(np.concatenate(pending, 1))

    rows = around.select("unit", "own", "side", "c", "n").repartition("unit").sortWithinPartitions("unit")
    return map_batches(rows, run, schema)


def _grid(table: DataFrame, of: np.ndarray, classes: int) -> np.ndarray:
    """How often classes follow each other, from the units' neighbours and their classes."""
    shared = table.sparkSession.sparkContext.broadcast(of)
    schema = _longs("cu", "cv", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = shared.value, np.zeros(classes * classes)
        for batch in batches:
            for after in batch.column(0):
                u, v, n = _unpacked(after.as_buffer())
                total += np.bincount(of[u].astype(np.int64) * classes + of[v], n, classes * classes)
        met = np.flatnonzero(total)
        yield _batch(schema, met // classes, met % classes, total[met])

    grid = np.zeros((classes, classes))
    for row in map_batches(table.select("after"), run, schema).groupBy("cu", "cv").agg(F.sum("n").alias("n")).collect():
        grid[row["cu"], row["cv"]] = row["n"]
    shared.unpersist()
    return grid


def _best(table: DataFrame, of: np.ndarray, chosen: np.ndarray, heavy: np.ndarray, grid: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray]:
    """The chosen units that fit another class better, and that class."""
    classes = len(grid)
    shared = table.sparkSession.sparkContext.broadcast((of, chosen, grid))
    schema = _longs("unit", "side", "c", "n")

    def counted(at: np.ndarray, c: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(at * classes + c, n, size * classes).reshape(size, classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, chosen, grid = shared.value
        total = np.zeros((3, len(heavy), classes))
        for batch in batches:
            for block in zip(*batch.columns):
                sides = []
                for side, data in enumerate(block):
                    pairs = _unpacked(data.as_buffer())
                    unit, other, n = pairs[:, chosen[pairs[0]]]
                    sides.append((unit[unit != other], of[other[unit != other]], n[unit != other]))
                    if side == 0:
                        itself = (unit[unit == other], of[unit[unit == other]], n[unit == other])
                sides.append(itself)
                units = np.unique(np.concatenate([unit for unit, _, _ in sides]))
                met = np.stack([counted(np.searchsorted(units, unit), c, n, len(units)) for unit, c, n in sides])
                often = np.isin(units, heavy)
                total[:, np.searchsorted(heavy, units[often])] += met[:, often]
                units, met = units[~often], met[:, ~often]
                for first in range(0, len(units), TOGETHER):
                    some = slice(first, first + TOGETHER)
                    own = of[units[some]].astype(np.int64)
                    to = best_classes(grid, own, met[0, some], met[1, some], met[2, some].sum(1))
                    other = np.flatnonzero(to != own)
                    yield _batch(schema, units[some][other], np.full(len(other), -1), to[other], np.ones(len(other)))
        side, at, c = np.nonzero(total)
        yield _batch(schema, heavy[at], side, c, total[side, at, c])

    found = map_batches(table, run, schema).groupBy("unit", "side", "c").agg(F.sum("n").alias("n")).toArrow()
    shared.unpersist()
    unit, side, c, n = (found[name].to_numpy() for name in schema.names)
    light = side < 0
    total = np.zeros((3, len(heavy), classes))
    total[side[~light], np.searchsorted(heavy, unit[~light]), c[~light]] = n[~light]
    met = np.flatnonzero(total.any((0, 2)))
    to = best_classes(grid, of[heavy[met]].astype(np.int64), *total[:2, met], total[2, met].sum(1))
    return np.append(unit[light], heavy[met]), np.append(c[light], to)


def cluster_packed(texts: DataFrame, units: Units, classes: int, passes: int, work: Work) -> tuple[DataFrame, np.ndarray]:
    """As ``cluster``, for complete units, whose neighbours stay in place; a pass moves a byte for each unit."""
    spark = texts.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    heavy = np.sort(units.table.where(F.col("n") * HEAVY > units.total).select("unit").toArrow()["unit"].to_numpy())
    table = neighbours(texts, units, heavy, work)
    spark._jvm.System.gc()  # lets Spark delete the shuffles so far
    of = np.arange(-WORDS, units.size - WORDS) % classes
    start = _start(units, classes).where(F.col("unit") < WORDS).toArrow()
    of[start["unit"].to_numpy()] = start["c"].to_numpy()
    of = of.astype(np.min_scalar_type(classes))
    most, stride, best = -np.inf, 2, None
    for number in range(passes + 1):
        grid = _grid(table, of, classes)
        now = information(grid)
        if now > most:
            best, most = (of, grid), now
        else:
            stride *= 2  # too many units moved at once
        if number == passes:
            break
        of, grid = best[0].copy(), best[1]
        chosen = np.zeros(len(of), bool)
        chosen[spark.range(len(of)).where(F.pmod(F.xxhash64("id", F.lit(number)), F.lit(stride)) == 0).toArrow()["id"].to_numpy()] = True
        unit, to = _best(table, of, chosen, heavy, grid)
        of[unit] = to
    work.drop("neighbours")
    shared, schema = spark.sparkContext.broadcast(best[0]), _longs("unit", "c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = batch.column(0).to_numpy()
            yield _batch(schema, unit, shared.value[unit])

    return work.keep(map_batches(units.table.select("unit"), run, schema), "assigned"), best[1]


def cluster(bigrams: DataFrame, units: Units, classes: int, passes: int, work: Work) -> tuple[DataFrame, np.ndarray]:
    """The table unit, c, and how often classes follow each other.

    The driver holds the class bigrams; units and their classes stay tables.
    """
    assigned = work.keep(_start(units, classes), "assigned-0")
    meets = lambda unit, own, side, c: F.struct(
        F.col(unit).alias("unit"), F.col(own).alias("own"), F.lit(side).cast("bigint").alias("side"), F.col(c).alias("c"))
    sides = F.when(F.col("u") == F.col("v"), F.array(meets("u", "cu", 2, "cu"))).otherwise(
        F.array(meets("u", "cu", 0, "cv"), meets("v", "cv", 1, "cu")))
    most, stride, best = -np.inf, 2, None
    for number in range(passes + 1):
        grid = np.zeros((classes, classes))
        for row in _classed(bigrams, assigned, units.complete).groupBy("cu", "cv").agg(F.sum("n").alias("n")).collect():
            grid[row["cu"], row["cv"]] = row["n"]
        now = information(grid)
        if now > most:
            best, most = (assigned, grid), now
        else:
            stride *= 2  # too many units moved at once
        if number == passes:
            break
        assigned, grid = best
        around = (_classed(bigrams, assigned, units.complete).select(F.explode(sides).alias("at"), "n").select("at.*", "n")
                  .where(F.pmod(F.xxhash64("unit", F.lit(number)), F.lit(stride)) == 0)
                  .groupBy("unit", "own", "side", "c").agg(F.sum("n").alias("n")))
        moved = _moves(around, grid)
        assigned = work.keep(assigned.join(moved, "unit", "left").select("unit", F.coalesce("to", "c").alias("c")),
                             f"assigned-{number + 1}")
        del around, moved
        bigrams.sparkSession._jvm.System.gc()  # lets Spark delete the shuffles of the pass
    return best


class Model:
    """Log10 probabilities by class and unit.

    ``known`` and the endings' arrays go to the tasks; the other words are in the table ``rare``.
    """

    def __init__(self, units: Units, assigned: DataFrame, grid: np.ndarray, work: Work):
        self.units = units
        overall = (grid.sum(0) + 0.5) / (grid.sum() + 0.5 * len(grid))
        self.step = np.log10((grid + CLASS_PRIOR * overall) / (grid.sum(1, keepdims=True) + CLASS_PRIOR))
        self.base = units.total + 0.5 * (units.vocabulary + 1)
        weighed = units.table.join(assigned.select("unit", "c"), "unit").withColumn("weight", F.col("n") + 0.5)
        in_class = weighed.groupBy("c").agg(F.sum("weight").alias("in_class"))
        self.table = work.keep(weighed.join(F.broadcast(in_class), "c").select(
            "unit", "c", F.log10(F.col("weight") / F.col("in_class")).alias("share"),
            (F.col("n") + 0.5 * (F.col("types") + 1)).alias("spread")), "model")
        known = self._valued(units.known).toArrow()
        self.known = Lexicon(known["word"].to_numpy(), n=known["n"].to_numpy(), c=known["c"].to_numpy().astype(np.int16),
                             own=known["own"].to_numpy())
        ending = self.table.where((F.col("unit") > END) & (F.col("unit") < WORDS)).toArrow()
        at, other = ending["unit"].to_numpy(), ending["unit"].to_numpy() == OTHER
        value = ending["share"].to_numpy() + np.log10(0.5 / ending["spread"].to_numpy())
        self.unseen = np.full(WORDS, ending["c"].to_numpy()[other][0]), np.full(WORDS, value[other][0])
        self.unseen[0][at], self.unseen[1][at] = ending["c"].to_numpy(), value
        self.rare = work.keep(self._valued(units.rare).select("word", "n", "c", "own"), "rare")

    def _valued(self, found: DataFrame) -> DataFrame:
        """Words with their class and own, the probability in it; a unit that is one word has nothing to spread."""
        own = (F.col("unit") == END) | (F.col("unit") >= WORDS)
        alone = found.where(own).join(self.table, "unit")
        others = found.where(~own).join(F.broadcast(self.table.where(F.col("unit") < WORDS)), "unit")
        spread = F.log10((F.col("n") + 0.5) / F.col("spread"))
        return (alone.withColumn("own", F.col("share") + F.when(F.col("n") > 0, 0.0).otherwise(spread))
                .unionByName(others.withColumn("own", F.col("share") + spread)))

    def _gathered(self, name: str) -> np.ndarray:
        return self.table.select("unit", name).toArrow().sort_by("unit")[name].to_numpy()

    @property
    def assigned(self) -> np.ndarray:
        """The class of every unit, by id; gathers the whole table, for small models."""
        return self._gathered("c")

    @property
    def unit_given_class(self) -> np.ndarray:
        """The probability of every unit in its class, by id; gathers the whole table, for small models."""
        return self._gathered("share")


def train(documents: DataFrame, work: Work, text: str = "text", classes: int = CLASSES, passes: int = PASSES
          ) -> tuple[Model, DataFrame]:
    """The model, and word, n, class and probability for the words that tasks do not know."""
    texts = documents.select(text)
    units = Units(work.keep(word_counts(texts), "counts"), work)
    if units.complete:
        assigned, grid = cluster_packed(texts, units, classes, passes, work)
    else:
        bigrams = work.keep(unit_bigrams(texts, units, work), "bigrams")
        assigned, grid = cluster(bigrams, units, classes, passes, work)
    model = Model(units, assigned, grid, work)
    return model, model.rare


def score(documents: DataFrame, model: Model, counts: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_tokens, n_known, base_score, score: one row per key.

    A task sums up what it knows of a document.  Each two adjacent words of which it does
    not know one go to the joins with ``counts``, once for each document and with their number;
    the second of them brings its own probabilities.  Where no rare word is a unit of its own, the task
    knows all classes, and a rare word goes to one join alone.
    """
    complete = model.units.complete
    shared = documents.sparkSession.sparkContext.broadcast((model.known, model.unseen, model.step, float(model.base)))
    longs = ("a", "b", "class_a", "class_b", "times", "tokens", "known")
    doubles = ("unseen", "base", "model")
    schema = T.StructType([T.StructField("key", documents.schema[key].dataType), *_longs(*longs),
                           *(T.StructField(name, T.DoubleType()) for name in doubles)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, (ending_class, ending_value), step, base = shared.value
        end = lexicon.values["c"][lexicon.find(np.array([END]))[0]]
        for batch in batches:
            for first, last, code, ending, sizes in tokens(batch.column(1)):
                at, known = lexicon.find(code)
                n = np.where(known, lexicon.values["n"][at], 0)
                c = np.where(known, lexicon.values["c"][at], ending_class[ending])
                row = np.repeat(np.arange(last - first), sizes)
                before, listed = np.append(end, c[:-1]), np.append(True, known[:-1])
                sure = known & listed | complete
                total = lambda x: np.bincount(row, x, last - first)
                value = total(np.where(known, lexicon.values["own"][at], 0) + np.where(sure, step[before, c], 0))
                plain = total(np.where(known, np.log10((n + 0.5) / base), 0))
                found = total(n > 0).astype(np.int64)

                open_ = np.flatnonzero(~(known & sure))
                a = np.where(sure, -1, np.where(listed, -1 - before, np.append(END, code[:-1])))[open_]
                b = np.where(known, -1 - c, code)[open_]
                order, starts = _runs(row[open_], a, b)
                times = np.diff(np.append(starts, len(order)))
                pick = order[starts]
                chosen, size = open_[pick], last - first
                zeros, none = np.zeros(size, np.int64), np.zeros(len(pick), np.int64)
                keys = batch.column(0).slice(first, size)
                columns = [np.append(zeros - 1, a[pick]), np.append(zeros - 1, b[pick]), np.append(zeros, before[chosen]),
                           np.append(zeros, c[chosen]), np.append(zeros, times), np.append(sizes, none),
                           np.append(found, none)]
                reals = [np.append(zeros, ending_value[ending[chosen]]), np.append(plain, none), np.append(value, none)]
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([keys, batch.column(0).take(pa.array(row[chosen] + first))]),
                     *(pa.array(x.astype(np.int64)) for x in columns), *(pa.array(x.astype(float)) for x in reals)],
                    names=schema.names)

    rows = map_batches(documents.select(key, text), run, schema)
    # what is known already has a key of its own in the joins, so that it spreads evenly
    for x in "b" if complete else "ab":
        side = counts.select(F.col("word").alias(f"word_{x}"), F.col("c").alias(f"c_{x}"),
                             *([F.col("n").alias("n_b"), F.col("own").alias("own_b")] if x == "b" else []))
        rows = rows.withColumn("_key", F.when(F.col(x) >= 0, F.col(x)).otherwise(_spread("key", "a", "b", "tokens", "base")))
        rows = rows.join(side, F.col("_key") == F.col(f"word_{x}"), "left").drop("_key")
    step = F.lit(0.0)
    if not complete:
        steps = F.array(*(F.lit(float(v)) for v in model.step.ravel()))
        at = F.coalesce("c_a", "class_a") * len(model.step) + F.coalesce("c_b", "class_b") + 1
        step = F.col("times") * F.element_at(steps, at.cast("int"))
    n, times, new = F.coalesce("n_b", F.lit(0)), F.col("times"), F.col("b") >= 0
    own = F.coalesce("own_b", "unseen")
    return rows.groupBy(F.col("key").alias(key)).agg(
        F.sum("tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(new & (n > 0), times).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.when(new, times * F.log10((n + 0.5) / F.lit(float(model.base)))).otherwise(0.0)).alias("base_score"),
        F.sum(F.col("model") + step + F.when(new, times * own).otherwise(0.0)).alias("score"))
