"""Runs of repeated words, found on a grammar of the texts.

A run is a stretch of words with a smallest period q, long enough to hold it ``MIN_EXPONENT`` times,
that no neighbouring word extends. Texts are read in blocks of whole documents. Re-Pair turns a
block's word ids into a grammar: in each round every pair that occurs twice or more, and more often
than the pairs it overlaps, is replaced by a nonterminal; the same pair always gets the same one.
When few pairs repeat, the rest of each document is paired by position, so that each document ends
as one symbol.

A run crosses the boundary between the two halves of the smallest nonterminal that spans it. So for
each nonterminal X -> YZ, once, on one of its places, all periods up to a quarter of its length are
tried at that boundary: a run of four periods has two of them on one side, which is one comparison
of two neighbouring stretches; the run's ends are found by binary search for the longest equal
extension. Stretches are compared by two polynomial hashes modulo primes, from prefix sums. The runs
found are then shifted to all places where X was derived. A run that was cut at the end of its
nonterminal lies in a longer one of the same period, found higher up; only maximal intervals stay.

Work is n log n at worst, also for one word repeated a million times, and memory follows the block,
that is ``BLOCK_WORDS`` or one long document. Nothing is shuffled and no model is shared.

Null texts are empty; they and texts of white space have no words and no runs. Ids are passed on as
they are, null or repeated, one row each. Other columns are not read, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm.common import SPACE_CLASS, batches_of, id_and_text, mixed, read, records, runs_of

#: A run has at least so many words, and holds its period at least so often (4 or more).
MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Words of a block of documents, about; a longer document is a block of its own.
BLOCK_WORDS = 1 << 17
#: Pairs of nonterminal and period that are tried at once.
TRIED = 1 << 19
#: Re-Pair ends when a round replaces less than one symbol in so many.
LEAST_SHARE = 200

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525)

RUNS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        (
            "runs",
            pa.list_(
                pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            ),
        ),
        ("collapsed", pa.string()),
    ]
)
RUNS_DDL = (
    "doc_id bigint, n_words bigint, "
    "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
)


class Repeats:
    """Whether stretches of a sequence equal those q places on."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        units = mixed(ids.astype(np.uint64) + np.uint64(1))
        self.tables = []
        for prime, base in zip(PRIMES, BASES):
            powers = np.ones(1, dtype=np.int64)
            while len(powers) <= len(ids):
                powers = np.concatenate((powers, powers * pow(base, len(powers), prime) % prime))
            values = (units % np.uint64(prime)).astype(np.int64)
            sums = np.zeros(len(ids) + 1, dtype=np.int64)
            # Places count down, so that a stretch further on has the smaller powers.
            np.cumsum(values * powers[len(ids) - 1 :: -1][: len(ids)] % prime, out=sums[1:])
            self.tables.append((prime, powers, sums))

    def same(self, low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
        """ids[low:high] == ids[low + q:high + q]"""
        equal = np.ones(len(low), dtype=bool)
        for prime, powers, sums in self.tables:
            here = (sums[high] - sums[low]) % prime
            there = (sums[high + q] - sums[low + q]) % prime
            equal &= here == there * powers[q] % prime
        return equal

    def reach(self, at: np.ndarray, q: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
        """How many neighbours of ``at``, up to ``room``, equal the word q places on.

        Forwards (step 1) ``at`` itself is the first one, backwards (-1) the one before it.
        """
        low, high = np.zeros_like(room), room.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            start, end = (at, at + middle) if step > 0 else (at - middle, at)
            good = self.same(start, end, q)
            low = np.where(open_ & good, middle, low)
            high = np.where(open_ & ~good, middle - 1, high)
        return low


class Grammar:
    """Nonterminals of a block, by number: length of both halves and one place; and all places."""

    def __init__(self, ids: np.ndarray, document: np.ndarray):
        n_ids = int(ids.max()) + 1 if len(ids) else 0
        lengths = np.ones(n_ids, dtype=np.int64)
        known = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        left, right, place, numbers, places = [], [], [], [], []
        symbols, starts, repeating = ids.astype(np.int64), np.arange(len(ids)), True
        while len(symbols):
            joins = document[1:] == document[:-1]
            alive = np.zeros(len(symbols), dtype=bool)
            alive[:-1] = joins
            alive[1:] |= joins
            symbols, starts, document = symbols[alive], starts[alive], document[alive]
            if not len(symbols):
                break
            joins = document[1:] == document[:-1]
            keys = (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:].astype(np.uint64)
            if repeating:
                at = most_frequent(keys, joins)
                repeating = len(at) * LEAST_SHARE >= len(symbols)
            if not repeating:
                firsts, lasts = runs_of(document)
                rank = np.arange(len(document)) - np.repeat(firsts, lasts - firsts)
                at = np.flatnonzero(joins & (rank[:-1] % 2 == 0))
            pairs, first, which = np.unique(keys[at], return_index=True, return_inverse=True)
            number, new = _numbered(pairs, known, len(lengths))
            one, other = symbols[at[first[new]]], symbols[at[first[new]] + 1]
            left.append(lengths[one])
            right.append(lengths[other])
            place.append(starts[at[first[new]]])
            numbers.append(number[which] - n_ids)
            places.append(starts[at])
            lengths = np.concatenate((lengths, lengths[one] + lengths[other]))
            known = _merged(known, pairs[new], number[new])
            symbols[at] = number[which]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, starts, document = symbols[keep], starts[keep], document[keep]
        self.left, self.right, self.place = _joined(left), _joined(right), _joined(place)
        self.numbers, self.places = _joined(numbers), _joined(places)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def most_frequent(keys: np.ndarray, joins: np.ndarray) -> np.ndarray:
    """Places of pairs to replace: repeated, more frequent than both pairs they overlap.

    Ties are broken by the pair's hash. Of neighbouring places of the same pair, as in a run of
    one word, every other one is taken.
    """
    _, which, counts = np.unique(keys[joins], return_inverse=True, return_counts=True)
    often = np.zeros(len(keys), dtype=np.uint64)
    often[joins] = counts[which]
    rank = np.where(often > 1, (often << np.uint64(32)) | (mixed(keys) >> np.uint64(32)), 0)
    firsts, lasts = runs_of(rank)
    own = rank[firsts]
    top = own > 0
    top[1:] &= own[1:] > own[:-1]
    top[:-1] &= own[:-1] > own[1:]
    sizes = lasts - firsts
    offset = np.arange(len(rank)) - np.repeat(firsts, sizes)
    return np.flatnonzero(np.repeat(top, sizes) & (offset % 2 == 0))


def _numbered(pairs: np.ndarray, known: tuple, following: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of each pair, places of the new ones); new pairs are numbered from ``following``."""
    keys, old = known
    number = np.full(len(pairs), -1, dtype=np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
        met = keys[at] == pairs
        number[met] = old[at[met]]
    new = np.flatnonzero(number < 0)
    number[new] = following + np.arange(len(new))
    return number, new


def _merged(known: tuple, pairs: np.ndarray, numbers: np.ndarray) -> tuple:
    at = np.searchsorted(known[0], pairs)
    return np.insert(known[0], at, pairs), np.insert(known[1], at, numbers)


def boundary_runs(
    grammar: Grammar, ids: np.ndarray, min_length: int, min_exponent: int
) -> tuple[np.ndarray, ...]:
    """(nonterminal, start within it, length, period) of runs across the halves' boundary."""
    repeats = Repeats(ids)
    whole = grammar.left + grammar.right
    periods = np.where(whole >= min_length, whole // min_exponent, 0)
    upto = np.cumsum(periods)
    found = []
    for at in range(0, int(upto[-1]) if len(upto) else 0, TRIED):
        tried = np.arange(at, min(at + TRIED, int(upto[-1])))
        node = np.searchsorted(upto, tried, side="right")
        q = tried - (upto[node] - periods[node]) + 1
        first = grammar.place[node]
        middle, end = first + grammar.left[node], first + whole[node]
        # Two periods to the left of the boundary, and the word after it.
        near = 2 * q <= grammar.left[node]
        near[near] = ids[middle[near]] == ids[(middle - q)[near]]
        near[near] = ids[middle[near] - 1] == ids[(middle - q)[near] - 1]
        near[near] = repeats.same((middle - 2 * q)[near], (middle - q)[near], q[near])
        # Two periods to the right, and the word before it.
        far = 2 * q <= grammar.right[node]
        far[far] = ids[middle[far] - 1] == ids[(middle + q)[far] - 1]
        far[far] = ids[middle[far]] == ids[(middle + q)[far]]
        far[far] = repeats.same(middle[far], (middle + q)[far], q[far])
        held = np.concatenate((np.flatnonzero(near), np.flatnonzero(far)))
        anchor = np.concatenate(((middle - q)[near], middle[far] - 1))
        node, q, first, end = node[held], q[held], first[held], end[held]
        start = anchor - repeats.reach(anchor, q, anchor - first, -1)
        stop = anchor + repeats.reach(anchor, q, end - q - anchor, 1) + q
        good = stop - start >= np.maximum(min_length, min_exponent * q)
        found.append((node[good], (start - first)[good], (stop - start)[good], q[good]))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    node, start, length, q = (np.concatenate(x) for x in zip(*found))
    # A stretch with a period has its multiples as well, with the same ends; the smallest counts.
    order = np.lexsort((q, length, start, node))
    node, start, length, q = node[order], start[order], length[order], q[order]
    least = np.ones(len(node), dtype=bool)
    least[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return node[least], start[least], length[least], q[least]


def runs_of_block(
    ids: np.ndarray, document: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of a block, by start and period.

    ``ids`` are the word ids of documents one after the other, ``document`` tells which is whose.
    """
    if min_exponent < 4:
        raise ValueError("min_exponent must be 4 or more")
    grammar = Grammar(ids, document)
    node, offset, length, q = boundary_runs(grammar, ids, min_length, min_exponent)
    held = np.bincount(node, minlength=len(grammar.place)) if len(node) else np.zeros(len(grammar.place), dtype=np.int64)
    firsts = np.cumsum(held) - held
    derived = np.flatnonzero(held[grammar.numbers] > 0)
    numbers, places = grammar.numbers[derived], grammar.places[derived]
    sizes = held[numbers]
    own = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(firsts[numbers], sizes)
    start, length, q = np.repeat(places, sizes) + offset[own], length[own], q[own]
    # Of one period, an interval inside another is a part of the same run.
    end = start + length
    order = np.lexsort((-end, start, q))
    start, end, q = start[order], end[order], q[order]
    group = np.cumsum(np.concatenate(([0], q[1:] != q[:-1]))) if len(q) else q
    ends = group * (len(ids) + 1) + end
    outer = np.ones(len(start), dtype=bool)
    outer[1:] = ends[1:] > np.maximum.accumulate(ends)[:-1]
    start, end, q = start[outer], end[outer], q[outer]
    order = np.lexsort((q, start))
    return start[order], (end - start)[order], q[order]


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, list[bytes]]]]:
    """(doc_id, words) of whole documents, up to ``BLOCK_WORDS`` words at once."""
    held, n = [], 0
    for doc_id, text in records(batches):
        words = text.split()
        if held and n + len(words) > BLOCK_WORDS:
            yield held
            held, n = [], 0
        held.append((doc_id, words))
        n += len(words)
    if held:
        yield held


def _rows(block: list[tuple[int, list[bytes]]], min_length: int, min_exponent: int) -> Iterator[tuple]:
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(words) for _, words in block])
    ids = np.array(
        [numbers.setdefault(w, len(numbers)) for _, words in block for w in words], dtype=np.int64
    )
    del numbers
    starts, lengths, periods = runs_of_block(
        ids, np.repeat(np.arange(len(block)), sizes), min_length, min_exponent
    )
    upto = np.cumsum(sizes)
    cuts = np.searchsorted(starts, np.concatenate(([0], upto)))
    for k, (doc_id, words) in enumerate(block):
        a, b, base = cuts[k], cuts[k + 1], upto[k] - sizes[k]
        if a == b:
            yield doc_id, len(words), [], b" ".join(words).decode()
            continue
        runs = [
            {"start": s, "length": n, "period": q}
            for s, n, q in zip((starts[a:b] - base).tolist(), lengths[a:b].tolist(), periods[a:b].tolist())
        ]
        depth = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(depth, starts[a:b] - base + periods[a:b], 1)
        np.add.at(depth, starts[a:b] - base + lengths[a:b], -1)
        kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()
        yield doc_id, len(words), runs, b" ".join([words[i] for i in kept]).decode()


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """Per document: doc_id, n_words, runs by start and period, and the text without repetitions.

    ``collapsed`` keeps the first period of each run, words joined by one space.
    """

    def search(batches):
        for block in blocks_of(batches):
            yield from batches_of(_rows(block, min_length, min_exponent), RUNS)

    return id_and_text(docs, id_col, text_col).mapInArrow(search, RUNS_DDL)


def digests(runs: DataFrame) -> DataFrame:
    """Counts, the longest run (ties: smallest start, then period) and digests of ``find_runs``."""
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return runs.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.n")).alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("(-1000 * longest.n) div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents, by the id's CRC, the words repeat from some place on.

    With h = crc32(doc_id), that is where h % 10 = 0: words from place a = g % n on repeat with period
    p = 1 + (n - a) / (3 + g % 8), for n words and g = h / 10. A null id leaves the text as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", SPACE_CLASS + "+"), ""))
    tail = F.expr("n - a")
    period = F.expr("slice(words, cast(a + 1 as int), cast(p as int))")
    repeated = F.flatten(F.array_repeat(period, F.expr("cast((n - a + p - 1) div p as int)")))
    planted = F.array_join(
        F.concat(F.expr("slice(words, 1, cast(a as int))"), F.slice(repeated, F.lit(1), tail.cast("int"))), " "
    )
    counted = (
        id_and_text(docs, "doc_id", "text")
        .withColumn("h", h)
        .withColumn("words", words)
        .withColumn("n", F.size("words").cast("bigint"))
        .withColumn("g", F.expr("h div 10"))
        .withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
        .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    )
    return counted.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_period_runs(spark: SparkSession, folder: str) -> DataFrame:
    return digests(find_runs(with_periods(read(spark, folder, "documents"))))
