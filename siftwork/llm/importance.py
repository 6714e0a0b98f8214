"""Importance resampling towards a target, by hashed word features.

Features are the runs of 1 to ``max_words`` consecutive words, joined by one space; a feature's
bucket is the CRC-32 of its bytes modulo the number of buckets. A bucket's gain is the logarithm of
its smoothed share in the target over its share in the documents, and a document weighs the sum of
the gains of its features. Adding Gumbel noise to the weights and taking the highest scores draws
documents without replacement, in proportion to their weights.

CRC-32 is affine in the message's bits. So a table holds what each byte value contributes at each
distance from a feature's end; a feature's CRC is the XOR of the contributions over its span, by one
``bitwise_xor.reduceat`` over all spans of a block of texts, and a constant for its length. Spans
longer than the table are cut into blocks of its size, counted from their end: the folded blocks
so far are shifted by one block's zero bytes, then the next block's XOR is added.

One pass over both tables counts buckets: each task sums its own, and the sums are merged by bucket.
The driver holds one gain per bucket, whatever the corpus. A second pass scores the documents. Ranks
come from a range partitioning by score and id, written once: a row's rank is its place in its
partition plus the sizes of the partitions before, so that no task sees all rows.

Null texts have no features, weight zero, and are not drawn if fewer than ``min_words`` words are
asked for. The noise of a null id is that of an empty one. Rows that share an id have the same noise
and are ranked as rows of their own; equal scores go by id (null last), then by number of features.
Other columns are not read, whatever their names. Without documents the result is empty; an empty
target has equal smoothed shares.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm.common import batches_of, id_and_text, read, records
from siftwork.plans.stage import Stage

BUCKETS = 10_000
MAX_WORDS = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: Distances from a feature's end that the table of contributions has.
SPAN = 64
#: Text bytes that are hashed at once, about.
BLOCK_BYTES = 1 << 20

#: Letters A-Z lower-cased; digits, letters and everything beyond ASCII as they are, the rest a space.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)

SCORED = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64())]
)
SCORED_DDL = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"


def _linear(message: bytes) -> int:
    """The CRC without the part that depends on the length alone."""
    return zlib.crc32(message) ^ zlib.crc32(bytes(len(message)))


def _contributions(span: int) -> np.ndarray:
    """[distance from the end, byte value]: what the byte adds to the CRC by XOR."""
    bits = [[_linear(bytes([1 << b]) + bytes(d)) for b in range(8)] for d in range(span)]
    table = np.zeros((span, 256), dtype=np.uint32)
    for b in range(8):
        has = (np.arange(256) >> b & 1).astype(bool)
        table[:, has] ^= np.array([row[b] for row in bits], dtype=np.uint32)[:, None]
    return table


TABLE = _contributions(SPAN)
#: A CRC's four bytes, each moved on by one block of zero bytes.
SHIFTED = np.array(
    [[_linear((byte << 8 * k).to_bytes(4, "little") + bytes(SPAN - 4)) for byte in range(256)] for k in range(4)],
    dtype=np.uint32,
)
#: The constants of lengths up to one block.
LENGTHS = np.array([zlib.crc32(bytes(n)) for n in range(SPAN + 1)], dtype=np.uint32)


def _moved_on(state: np.ndarray) -> np.ndarray:
    """States after one more block of zero bytes; a state acts like the message's next four bytes."""
    out = SHIFTED[0][state & 255]
    for k in (1, 2, 3):
        out = out ^ SHIFTED[k][state >> np.uint32(8 * k) & 255]
    return out


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of bytes; spans are not empty and may overlap."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint32)
    sizes = ends - starts
    blocks = -(-sizes // SPAN)
    # Blocks of a span from its first, which may be short, to its last.
    first = np.cumsum(blocks) - blocks
    of = np.repeat(np.arange(len(starts)), blocks)
    left = np.repeat(blocks, blocks) - (np.arange(len(of)) - first[of])  # blocks from here to the end
    block_ends = ends[of] - (left - 1) * SPAN
    block_starts = np.maximum(starts[of], block_ends - SPAN)
    lengths = block_ends - block_starts
    at = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(at - block_starts, lengths)
    distance = np.repeat(block_ends, lengths) - place - 1
    folded = np.bitwise_xor.reduceat(TABLE.ravel()[distance * 256 + data[place]], at)
    state = folded[first]
    constant = LENGTHS[np.minimum(sizes, SPAN)]
    long = np.flatnonzero(blocks > 1)
    for step in range(1, int(blocks.max())):
        long = long[blocks[long] > step]
        state[long] = _moved_on(state[long]) ^ folded[first[long] + step]
    for size in np.unique(sizes[sizes > SPAN]).tolist():
        constant[sizes == size] = zlib.crc32(bytes(size))
    return state ^ constant


def feature_buckets(texts: list[bytes], max_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, its text's number, words of each text)."""
    lines = [b" ".join(text.translate(PLAIN).split()) for text in texts]
    n_words = np.array([line.count(b" ") + 1 if line else 0 for line in lines], dtype=np.int64)
    data = np.frombuffer(b" ".join(line for line in lines if line), dtype=np.uint8)
    blanks = np.flatnonzero(data == 32)
    starts = np.concatenate(([0], blanks + 1)) if len(data) else blanks
    ends = np.concatenate((blanks, [len(data)])) if len(data) else blanks
    owner = np.repeat(np.arange(len(lines)), n_words)
    found, owners = [], []
    for k in range(max_words):
        whole = owner[: len(owner) - k] == owner[k:]
        crcs = span_crcs(data, starts[: len(starts) - k][whole], ends[k:][whole])
        found.append((crcs % np.uint32(buckets)).astype(np.int64))
        owners.append(owner[k:][whole])
    return np.concatenate(found), np.concatenate(owners), n_words


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts, size = [], [], 0
    for doc_id, text in records(batches):
        ids.append(doc_id)
        texts.append(text)
        size += len(text)
        if size >= BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def bucket_counts(table: DataFrame, max_words: int, buckets: int) -> np.ndarray:
    """Features of a table (columns of ``id_and_text``) in each bucket; at most ``buckets`` rows reach the driver."""

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for _, texts in _blocks(batches):
            total += np.bincount(feature_buckets(texts, max_words, buckets)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held), "n": pa.array(total[held])})

    counted = table.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in counted.collect():
        out[row.bucket] = row.n
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed shares' ratio) by bucket."""
    n, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (all_source + n) / ((s + 1.0) * (all_target + n))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, fixed by seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(
    docs: DataFrame,
    target: DataFrame,
    max_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score. Tables as of ``id_and_text``."""
    gains = docs.sparkSession.sparkContext.broadcast(
        gains_of(bucket_counts(docs, max_words, buckets), bucket_counts(target, max_words, buckets))
    )

    def score(batches):
        def rows():
            for ids, texts in _blocks(batches):
                found, owner, n_words = feature_buckets(texts, max_words, buckets)
                n_features = np.bincount(owner, minlength=len(ids)).tolist()
                weights = np.zeros(len(ids), dtype=np.int64)
                np.add.at(weights, owner, gains.value[found])
                for i, n, m, weight in zip(ids, n_words.tolist(), n_features, weights.tolist()):
                    yield i, n, m, weight, weight + noise(i, seed)

        return batches_of(rows(), SCORED)

    return docs.mapInArrow(score, SCORED_DDL)


def drawn(scored: DataFrame, stage: Stage, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """The columns of ``score_documents`` and the rank of those drawn, null for the others."""
    scored = stage.table(scored, "scored", "zstd")
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    eligible = scored.filter(F.col("n_words") >= min_words)
    placed = eligible.repartitionByRange(*order).sortWithinPartitions(*order)
    # Ids count up within a partition, so their low bits are the row's place in it.
    place = F.monotonically_increasing_id()
    placed = placed.select("*", F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("place"))
    placed = stage.table(placed, "placed", "zstd")
    sizes = sorted(tuple(row) for row in placed.groupBy("part").count().collect())
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    offsets = scored.sparkSession.createDataFrame(before, "part bigint, before bigint")
    rank = F.col("before") + F.col("place") + 1
    ranked = placed.join(F.broadcast(offsets), "part").select(
        *scored.columns, F.when(rank <= percent * total // 100, rank).alias("rank")
    )
    others = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.union(others)


def resample(
    docs: DataFrame,
    target: DataFrame,
    stage: Stage,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    max_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Every document with n_words, n_features, weight, score and, if it is drawn, its rank from 1."""
    plain = id_and_text(docs, id_col, text_col)
    wanted = target.select(
        F.lit(None).cast("bigint").alias("doc_id"),
        F.coalesce(target[target_text_col].cast("string"), F.lit("")).alias("text"),
    )
    scored = score_documents(plain, wanted, max_words, buckets, seed)
    return drawn(scored, stage, min_words, percent)


def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    docs, target = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    chosen = resample(docs, target, Stage(spark))
    return chosen.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = {
    "op12_importance": r"""
WITH RECURSIVE shifted AS (
    SELECT range AS byte, range AS value, 0 AS step FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, step + 1
    FROM shifted WHERE step < 8
), crc_table AS (
    SELECT byte, value FROM shifted WHERE step = 8
), texts AS (
    SELECT 0 AS target, row_number() OVER () AS row_id, doc_id, text FROM documents
    UNION ALL
    SELECT 1, row_number() OVER (), NULL, text FROM benchmark
), words AS (
    SELECT target, row_id, doc_id, list_filter(
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM texts
), features AS (
    SELECT target, row_id, unnest(words) AS word FROM words
), folded AS (
    SELECT word, hex(encode(word)) AS code, 0 AS done, 4294967295::BIGINT AS crc FROM (SELECT DISTINCT word FROM features)
    UNION ALL
    SELECT word, code, done + 1, xor(crc >> 8, value)
    FROM folded JOIN crc_table ON byte = xor(crc, ('0x' || substr(code, 2 * done + 1, 2))::BIGINT) & 255
    WHERE 2 * done < length(code)
), buckets AS (
    SELECT word, xor(crc, 4294967295) % 10000 AS bucket FROM folded WHERE 2 * done = length(code)
), held AS (
    SELECT target, row_id, bucket FROM features JOIN buckets USING (word)
), counts AS (
    SELECT bucket, count(*) FILTER (target = 0) AS s, count(*) FILTER (target = 1) AS t FROM held GROUP BY bucket
), totals AS (
    SELECT coalesce(sum(s), 0)::BIGINT AS all_s, coalesce(sum(t), 0)::BIGINT AS all_t FROM counts
), gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + 10000))::DOUBLE / ((s + 1) * (all_t + 10000))::DOUBLE))::BIGINT AS gain
    FROM counts, totals
), weights AS (
    SELECT row_id, sum(gain)::BIGINT AS weight FROM held JOIN gains USING (bucket) WHERE target = 0 GROUP BY row_id
), scored AS (
    SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                       / 4294967296::DOUBLE)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (row_id)
    WHERE target = 0
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
}
