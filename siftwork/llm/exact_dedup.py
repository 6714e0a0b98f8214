"""Exact deduplication over an extendible-hash index on shared files, in DataFrame functions.

Every normalised text gets a 64-bit hash. The index's directory is addressed by the hash's leading bits
and grown from the counts of different hashes alone: it starts with one bucket; as long as a
bucket holds more than ``capacity`` of them it is split by one more bit, and the directory doubles
when that bit is new to it. ``capacity`` grows with the corpus, so that the directory keeps below a few
times 2**MAX_BUCKETS_LOG slots, which are sent to all tasks.

The directory then routes each row to its bucket, in the one exchange that texts go through. The task
that owns a bucket, a range of keys, chains its rows by hash and compares bytes within a chain: rows of
equal texts form a group, ordered so that the one that stays comes first. It answers for its
rows, and the buckets are written as files, sorted by bucket and hash, in which the first row of each
text carries the bytes.

A hash held by more than a thousandth of the rows (``HOT_SHARE``) is hot; there are at most a thousand.
Its rows are dealt over several parts of the bucket by id and text, and the parts' first rows, a few for each
hot text, are chained and compared once more. So no task gets more than a small share of a text's copies, unless
they are the same row with the same id over and over, which meet in one task that sorts them.

Nulls count as empty texts, which are copies of each other and of texts of white space only.
Equal texts of equal length leave the one with the smallest id; a null id comes after all others, and
of rows with one id one stays. Each row gets its own answer, so repeated or null ids lose and keep no
other row. Other columns pass through only where ``carry`` names them; names that start with
``__siftwork_`` are taken. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwork.llm.common import read
from siftwork.plans.stage import Stage

#: Different hashes that a bucket takes before it is split, at least.
CAPACITY = 500
#: The directory has some 2**MAX_BUCKETS_LOG buckets at most; larger corpora have larger buckets.
MAX_BUCKETS_LOG = 15
#: A hash of more than one in so many rows is hot, if these are HOT_ROWS at least.
HOT_SHARE, HOT_ROWS = 1000, 1000
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

_H = "__siftwork_"
HASH, PLAIN, BUCKET, PART, POINTS, ID = (_H + x for x in ("hash", "plain", "bucket", "part", "points", "id"))
NTH, SIZE, KEEP, TIE = (_H + x for x in ("nth", "size", "keep", "tie"))


@dataclass(frozen=True)
class Directory:
    """The buckets of a directory, named by their leading bits, each with its own depth."""

    depth: int
    buckets: tuple[tuple[int, int], ...]  # (bits, depth)

    def slots(self) -> list[tuple[int, int]]:
        """(slot, bucket): every slot points at the first slot of its bucket."""
        out = []
        for bits, depth in self.buckets:
            first = bits << (self.depth - depth)
            out += [(first + i, first) for i in range(1 << (self.depth - depth))]
        return out

    def route(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the bucket of their hash; the slots are few whatever the corpus."""
        if self.depth == 0:
            return rows.withColumn(BUCKET, F.lit(0))
        slot = _H + "slot"
        slots = rows.sparkSession.createDataFrame(self.slots(), f"{slot} int, {BUCKET} int")
        return rows.withColumn(slot, leading_bits(F.col(HASH), self.depth)).join(F.broadcast(slots), slot).drop(slot)


def leading_bits(hash_column: Column, depth: int) -> Column:
    if depth == 0:
        return F.lit(0)
    return F.shiftrightunsigned(hash_column, 64 - depth).cast("int")


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), SPACES, "")


def grow_directory(hashes: DataFrame, capacity: int = CAPACITY, n_hashes: int | None = None) -> Directory:
    """Split overfull buckets until all fit, counting only the buckets that were just split.

    ``hashes`` has a row for each different hash, so a bucket always gets smaller by splitting. A round is
    one count by leading bits; the driver holds the numbers of the buckets.
    """
    n = hashes.count() if n_hashes is None else n_hashes
    capacity = max(capacity, n >> MAX_BUCKETS_LOG)
    done: list[tuple[int, int]] = []
    depth = 0
    overfull = [0] if n > capacity else []
    if not overfull:
        return Directory(0, ((0, 0),))
    while overfull and depth < 30:
        depth += 1
        inside = _H + "parent"
        parents = hashes.sparkSession.createDataFrame([(x,) for x in overfull], f"{inside} int")
        counted = dict(
            hashes.join(F.broadcast(parents), leading_bits(F.col(HASH), depth - 1) == F.col(inside))
            .groupBy(leading_bits(F.col(HASH), depth).alias("bits"))
            .count()
            .collect()
        )
        children = [2 * parent + bit for parent in overfull for bit in (0, 1)]
        overfull = [bits for bits in children if counted.get(bits, 0) > capacity]
        done += [(bits, depth) for bits in children if counted.get(bits, 0) <= capacity]
    return Directory(depth, tuple(sorted(done + [(bits, depth) for bits in overfull])))


def _before() -> list[Column]:
    return [F.desc(POINTS), F.asc_nulls_last(ID), F.asc(TIE)]


def chained(
    docs: DataFrame,
    stage: Stage,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    hot_rows: int = HOT_ROWS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Each row in its bucket, with its place in the chain of its text's copies.

    Columns: those of ``carry``, and the ``__siftwork_`` ones for hash, bucket, plain text, id, place
    (1 stays), size of the group, and the id that stays.
    """
    # A text that is carried along anyway is not sent twice.
    text = text_col if text_col in carry else _H + "text"
    own_text = [] if text_col in carry else [docs[text_col].cast("string").alias(text)]
    rows = docs.select(*[docs[name] for name in carry], docs[id_col].cast("bigint").alias(ID), *own_text)
    # Rows of one id and text may differ in other columns; these decide then.
    tie = F.xxhash64(*[rows[name] for name in carry]) if carry else F.lit(0).cast("bigint")
    rows = rows.withColumns({HASH: F.xxhash64(normalised(F.col(text))), TIE: tie})
    counted = rows.groupBy(HASH).agg(F.count(F.lit(1)).alias("copies"))
    counted = stage.table(counted, "hashes", "zstd")
    n_hashes, n_rows = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0))).first()
    directory = grow_directory(counted.select(HASH), capacity, n_hashes)
    limit = max(hot_rows, n_rows // HOT_SHARE)
    hot = counted.filter(F.col("copies") > limit)
    # At most HOT_SHARE rows.
    parts = [(row[HASH], -(-row.copies // limit)) for row in hot.collect()]
    stage.drop_table(counted)
    own = _placed(rows, text, directory, parts)
    if not parts:
        return own
    firsts = own.filter((F.col(NTH) == 1) & F.col(HASH).isin([h for h, _ in parts]))
    firsts = firsts.select(HASH, PLAIN, PART, POINTS, ID, TIE, F.col(SIZE).alias(_H + "held"))
    group = Window.partitionBy(HASH, PLAIN)
    order = group.orderBy(*_before(), PART)
    merged = firsts.select(
        F.col(HASH).alias(_H + "of_hash"),
        F.unhex(F.sha2(PLAIN, 256)).alias(_H + "of_digest"),
        F.col(PART).alias(_H + "of_part"),
        F.row_number().over(order).alias(_H + "of_rank"),
        F.first(ID).over(order).alias(_H + "of_keep"),
        F.sum(_H + "held").over(group).alias(_H + "of_total"),
    )
    # A few rows for each hot text, at most 2 * HOT_SHARE and their collisions.
    merged = F.broadcast(stage.table(merged, "hot", "uncompressed"))
    same = (F.col(HASH) == F.col(_H + "of_hash")) & (F.col(PART) == F.col(_H + "of_part"))
    same &= F.unhex(F.sha2(PLAIN, 256)) == F.col(_H + "of_digest")
    return own.join(merged, same, "left").select(
        *[own[name] for name in own.columns if name not in (NTH, SIZE, KEEP)],
        F.when((F.col(_H + "of_rank") > 1) & (F.col(NTH) == 1), 2).otherwise(F.col(NTH)).alias(NTH),
        F.coalesce(_H + "of_total", SIZE).alias(SIZE),
        F.when(F.col(_H + "of_rank").isNotNull(), F.col(_H + "of_keep")).otherwise(F.col(KEEP)).alias(KEEP),
    )


def _placed(rows: DataFrame, text: str, directory: Directory, parts: list[tuple[int, int]]) -> DataFrame:
    """Rows in the tasks that own their buckets, chained by hash and compared by bytes."""
    routed, owner = directory.route(rows), [BUCKET]
    if parts:
        dealt = rows.sparkSession.createDataFrame(parts, f"{_H}of_hash bigint, {_H}parts bigint")
        part = F.pmod(F.xxhash64(ID, text), F.col(_H + "parts"))
        routed = routed.join(F.broadcast(dealt), F.col(HASH) == F.col(_H + "of_hash"), "left")
        routed = routed.withColumn(PART, F.coalesce(part, F.lit(0)).cast("int")).drop(_H + "of_hash", _H + "parts")
        owner.append(PART)
    owned = routed.repartition(*owner).select(
        *[name for name in routed.columns if name != _H + "text"],
        normalised(F.col(text)).alias(PLAIN),
        F.length(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("bigint").alias(POINTS),
    )
    # Rows are where the windows need them: the exchange by owner is the only one.
    group = Window.partitionBy(*owner, HASH, PLAIN)
    order = group.orderBy(*_before())
    return owned.select(
        "*",
        F.row_number().over(order).alias(NTH),
        F.first(ID).over(order).alias(KEEP),
    ).withColumn(SIZE, F.count(F.lit(1)).over(group))


def build_index(docs: DataFrame, stage: Stage, **options: object) -> DataFrame:
    """The buckets as a table on shared files, a row for each document.

    Columns: bucket, hash, digest, doc_id, nth (1 stays), keep_id, group_size, and bytes, the normalised
    text, on the first row of each text. Options are those of ``chained``.
    """
    rows = chained(docs, stage, **options).select(
        F.col(BUCKET).alias("bucket"),
        F.col(HASH).alias("hash"),
        F.unhex(F.sha2(PLAIN, 256)).alias("digest"),
        F.col(ID).alias("doc_id"),
        F.col(NTH).alias("nth"),
        F.col(KEEP).alias("keep_id"),
        F.col(SIZE).alias("group_size"),
        F.when(F.col(NTH) == 1, F.col(PLAIN)).alias("bytes"),
    )
    return stage.table(rows.sortWithinPartitions("bucket", "hash"), "index", "zstd")


def find_copies(docs: DataFrame, stage: Stage, **options: object) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket."""
    return build_index(docs, stage, **options).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("nth") == 1).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "bucket",
    )


def keep_first_copies(docs: DataFrame, stage: Stage, **options: object) -> DataFrame:
    """The documents that stay, with all their columns, straight from the tasks that own the buckets."""
    kept = chained(docs, stage, carry=docs.columns, **options).filter(F.col(NTH) == 1)
    return kept.select(*docs.columns)


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    copies = find_copies(read(spark, folder, "documents"), Stage(spark))
    return copies.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = {
    "op9_exact_dedup": r"""
WITH plain AS (
    SELECT doc_id,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bytes,
           length(coalesce(text, '')) AS n_points
    FROM documents
), grouped AS (
    SELECT doc_id, bytes,
           first_value(doc_id) OVER (PARTITION BY bytes ORDER BY n_points DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY bytes) AS group_size
    FROM plain
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bytes) AS text_sha256
FROM grouped
"""
}
