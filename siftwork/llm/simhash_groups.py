"""Near duplicates by SimHash fingerprints, with a covering code's words as anchors.

A fingerprint has a bit set if more than half of a text's shingle hashes have it. Two fingerprints
link if they differ in at most ``max_distance`` bits. Fingerprints are cut into parts, one more than
half that bound, so that two that link differ in at most one bit in one of the parts.

Anchors are the words of a Hamming code of a part's length: each point lies within radius 1 of
exactly one anchor, its home. Each fingerprint is replicated to every anchor within the covering
radius plus the threshold left to the part, 1 + 1 bits: of two parts one bit apart, each visits the
home of the other. There are at most (length + 1) / 2 such anchors, read from a table by the part's
syndrome. For parts of 32 bits, of which the code takes 31, a fingerprint is 16 rows of 2**26
anchors. Only different fingerprints are replicated; copies wait at theirs.

At each anchor, fingerprints at home are compared with its visitors, whole fingerprints by the bits
they differ in. Anchors without two fingerprints and a home drop out after a count. Anchors with
many are dealt into blocks, each home with each visitor in one block, so that no task holds
more than two blocks. Tasks put out a tree for each component among the links they find, never all pairs,
and components of all links follow by alternating stars. The work in an anchor
is the product of its homes and visitors; a cluster of different fingerprints around one point shares anchors.

Null texts are empty; texts without words have fingerprint zero and link like any other. Of
equal ids each row is a row of its own, with its text's fingerprint. Null ids have a fingerprint and
link; they name a component only if it has no other id, as null. Other columns are not read,
whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm.common import batches_of, id_and_text, read, records
from siftwork.llm.components import components
from siftwork.plans.stage import Stage

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
BITS = 64
#: Members of an anchor, at home or visiting, that are compared as one block.
BLOCK = 2048
#: Pairs of fingerprints that are compared at once.
PAIRS = 1 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
    return np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that more than half of the hashes have, as a signed 64-bit number."""
    total = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype("<u8")
        total += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fp of a table with the columns of ``id_and_text``."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        return batches_of(((i, fingerprint(shingle_hashes(text, width))) for i, text in records(batches)), schema)

    return docs.mapInArrow(run, "doc_id bigint, fp bigint")


def hamming_checks(part_bits: int) -> int:
    """Check bits of the longest Hamming code that fits a part."""
    return (part_bits + 1).bit_length() - 1


def visits(checks: int) -> list[list[int]]:
    """By syndrome: the masks that lead from a part to the code words within two bits, home first.

    The syndrome is the XOR of the numbers, from 1, of the bits that are set. Flipping the bits
    whose numbers' XOR is the syndrome gives a code word.
    """
    out = [[0]]
    for syndrome in range(1, 1 << checks):
        pairs = [(i, i ^ syndrome) for i in range(1, 1 << checks) if i < i ^ syndrome]
        out.append([1 << syndrome - 1, *((1 << i - 1) | (1 << j - 1) for i, j in pairs)])
    return out


def _syndrome(part: Column, checks: int) -> Column:
    total = F.lit(0)
    for k in range(checks):
        mask = sum(1 << i - 1 for i in range(1, 1 << checks) if i >> k & 1)
        total = total + F.shiftleft(F.bit_count(part.bitwiseAND(F.lit(mask))) % 2, k)
    return total


def replicated(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Rows part, anchor, at_home, fp: each fingerprint of ``prints`` at all its anchors."""
    n_parts = max_distance // 2 + 1
    part_bits = BITS // n_parts
    checks = hamming_checks(part_bits)
    masks = F.array(*[F.array(*[F.lit(m).cast("bigint") for m in row]) for row in visits(checks)])
    length = (1 << checks) - 1
    cut = [F.shiftrightunsigned("fp", k * part_bits).bitwiseAND(F.lit((1 << length) - 1)) for k in range(n_parts)]
    parts = prints.select("fp", F.posexplode(F.array(*cut)).alias("part", "bits"))
    moved = parts.select("fp", "part", "bits", _syndrome(F.col("bits"), checks).alias("syndrome"))
    at = F.posexplode(F.element_at(masks, F.col("syndrome") + 1)).alias("nth", "mask")
    return moved.select("fp", "part", "bits", at).select(
        "part", F.col("bits").bitwiseXOR(F.col("mask")).alias("anchor"), (F.col("nth") == 0).alias("at_home"), "fp"
    )


def _dealt(members: DataFrame, block: int) -> DataFrame:
    """The members of anchors that can hold a link, with the block in which they are compared.

    An anchor's block is a pair of numbers: a home has one of the first and all of the second, a
    visitor the other way round. A home also visits its anchor.
    """
    counted = members.groupBy("part", "anchor").agg(
        F.sum(F.col("at_home").cast("bigint")).alias("homes"), F.count("*").alias("visitors")
    )
    counted = counted.filter("homes > 0 and visitors > 1").select(
        F.col("part").alias("of_part"), F.col("anchor").alias("of_anchor"),
        F.expr(f"cast((homes + {block - 1}) div {block} as int)").alias("home_blocks"),
        F.expr(f"cast((visitors + {block - 1}) div {block} as int)").alias("visitor_blocks"),
    )
    met = members.join(counted, (F.col("part") == F.col("of_part")) & (F.col("anchor") == F.col("of_anchor")))
    own = lambda n: F.pmod(F.xxhash64("fp"), n.cast("bigint")).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    n_home, n_visitor = F.col("home_blocks"), F.col("visitor_blocks")
    homes = met.filter("at_home").select(
        "part", "anchor", "fp", F.lit(True).alias("home"), own(n_home).alias("h"), F.explode(every(n_visitor)).alias("v")
    )
    visitors = met.select(
        "part", "anchor", "fp", F.lit(False).alias("home"), F.explode(every(n_home)).alias("h"), own(n_visitor).alias("v")
    )
    return homes.union(visitors)


def linked_pairs(
    homes: np.ndarray, visitors: np.ndarray, n_homes: np.ndarray, n_visitors: np.ndarray, max_distance: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of home and visitor within the distance, for groups that lie one after the other."""
    upto = np.cumsum(n_homes * n_visitors)
    first_home, first_visitor = np.cumsum(n_homes) - n_homes, np.cumsum(n_visitors) - n_visitors
    found = []
    for at in range(0, int(upto[-1]) if len(upto) else 0, PAIRS):
        pair = np.arange(at, min(at + PAIRS, int(upto[-1])))
        group = np.searchsorted(upto, pair, side="right")
        pair -= (upto - n_homes * n_visitors)[group]
        a = homes[first_home[group] + pair // n_visitors[group]]
        b = visitors[first_visitor[group] + pair % n_visitors[group]]
        near = (a != b) & (np.bitwise_count((a ^ b).view(np.uint64)) <= max_distance)
        found.append(forest(a[near], b[near]))
    if not found:
        return homes[:0], visitors[:0]
    a, b = (np.concatenate(x) for x in zip(*found))
    return forest(a, b) if len(found) > 1 else (a, b)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node of its component) that join what the links a, b join, and no more."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low < high
        a, b = a[open_], b[open_]
        np.minimum.at(root, high[open_], low[open_])
        while (root[root] != root).any():
            root = root[root]
    hangs = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[hangs], nodes[root[hangs]]


def _compared(batches: Iterator[pa.RecordBatch], max_distance: int) -> Iterator[pa.RecordBatch]:
    """Links of members that come sorted by part, anchor, block; a block is held until it is whole."""
    names = ("part", "anchor", "h", "v", "home", "fp")
    held = None
    for batch in batches:
        new = [batch.column(name).to_numpy(zero_copy_only=False) for name in names]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        if not len(held[0]):
            continue
        starts = _block_starts(held)
        if len(starts) > 1:
            yield from _links([x[: starts[-1]] for x in held], max_distance)
            held = [x[starts[-1] :] for x in held]
    if held is not None and len(held[0]):
        yield from _links(held, max_distance)


def _block_starts(members: list[np.ndarray]) -> np.ndarray:
    cut = np.zeros(len(members[0]), dtype=bool)
    cut[0] = True
    for column in members[:4]:
        cut[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(cut)


def _links(members: list[np.ndarray], max_distance: int) -> Iterator[pa.RecordBatch]:
    starts, home, fp = _block_starts(members), members[4], members[5]
    n_homes = np.add.reduceat(home.astype(np.int64), starts)
    n_visitors = np.add.reduceat((~home).astype(np.int64), starts)
    a, b = linked_pairs(fp[home], fp[~home], n_homes, n_visitors, max_distance)
    if len(a):
        yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})


def find_links(prints: DataFrame, stage: Stage, max_distance: int = MAX_DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join the components of different fingerprints ``fp``."""
    if not 0 <= max_distance <= 20:
        raise ValueError("max_distance must lie between 0 and 20")
    members = stage.table(replicated(prints, max_distance), "members", "zstd")
    key = ["part", "anchor", "h", "v"]
    dealt = _dealt(members, block).repartition(*key).sortWithinPartitions(*key)

    def compare(batches):
        return _compared(batches, max_distance)

    return dealt.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    stage: Stage,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest id reachable by links)."""
    plain = id_and_text(docs, id_col, text_col)
    printed = stage.table(fingerprints(plain, width), "fingerprints", "zstd")
    distinct = stage.table(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct", "zstd")
    links = stage.table(find_links(distinct.select("fp"), stage, max_distance, block), "links", "zstd")
    found = components(links, stage)
    placed = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    placed = stage.table(placed, "placed", "zstd")
    # Most fingerprints are alone; those that are not are few, and a component may hold many of them.
    heads = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.select(F.col("fp").alias("of_fp"), F.col("component").alias("of"))
    named = named.join(heads, F.col("of") == F.col("component")).select("of_fp", "component_id")
    return printed.join(named, F.col("fp") == F.col("of_fp")).select("doc_id", "fp", "component_id")


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(read(spark, folder, "documents"), Stage(spark))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
