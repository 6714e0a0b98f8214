"""Removal of lines that an earlier line equals but for one edit, by deletion neighbourhoods.

Two lines are within one edit if one is the other with a character deleted, or if both give the
same string when the character at one place is deleted. So a line's keys are the hash of itself,
the hashes of all its deletion variants as whole strings, and the hashes of its variants together
with the place. Equal keys meet in a group-by that keeps the earliest line of each key and kind;
no pairs within a group are formed. The edit distance to the earliest line is then verified on the
texts. A line goes if any earlier line, by doc_id and line number, is within one edit of it.

Few lines have such a neighbour, and variants are many, so lines are first split into four parts:
an edit leaves three of them as they are. Hashes of the other three parts, for the line's own
length and the next smaller one, are counted over different lines; lines that share none can't have
a neighbour and emit no variants. A bitmap of shared hashes, of fixed size, thins lines out, and the
whole hashes of those that pass decide. Variants go with a line's rank by first place, in eight bytes.

Lines end at newlines. Empty lines stay and are not compared; all others are, of every length, unless
``min_chars`` asks that shorter ones be compared for equality only. Null texts are empty. Of rows with
one id (null first) and different texts, those with the smaller hash of the text are earlier; rows that are equal in id and text are
one document given several times, and each keeps the same lines. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwork.llm.common import (
    RollingHashes,
    batches_of,
    cell_bitmap,
    flagged,
    give_back,
    mixed,
    read,
    small,
)
from siftwork.llm.substring_dedup import with_key
from siftwork.plans.stage import Stage

PARTS = 4
MIN_CHARS = 1
#: Bits of the bitmap of part hashes that different lines share.
BITS = 26
#: Characters that are hashed at once.
BLOCK = 200_000
#: Rows and bytes that go to a Python worker at once; executors keep buffers of the largest batch.
ROWS_AT_ONCE, BYTES_AT_ONCE = 1000, 4 << 20

_letters = RollingHashes(0x9E3779B97F4A7C15)
_places = RollingHashes(0xC2B2AE3D27D4EB4F)


class Lines:
    """The lines of several texts, hashed together."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts)
        self.codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        ends = np.append(np.flatnonzero(self.codes == 10), len(self.codes))
        self.starts, self.ends = np.append(0, ends[:-1] + 1), ends
        self.sizes = self.ends - self.starts
        self.text = joined
        counts = [text.count("\n") + 1 for text in texts]
        self.owner = np.repeat(np.arange(len(texts)), counts)
        firsts = np.cumsum([0, *counts[:-1]])
        self.number = np.arange(len(ends)) - firsts[self.owner]
        units = mixed(self.codes.astype(np.uint64) + np.uint64(1))
        self.sums = _letters.sums(units)
        self.keys = _letters.stretches(self.sums, self.starts, self.ends)
        self.second = _places.stretches(_places.sums(units), self.starts, self.ends)

    def part_keys(self, chosen: np.ndarray):
        """For both lengths and each part: the part's range in the line, and the others' hash."""
        starts, ends, sizes = self.starts[chosen], self.ends[chosen], self.sizes[chosen]
        for shorter in (0, 1):
            n = sizes - shorter
            for part in range(PARTS):
                a, b = n * part // PARTS, n * (part + 1) // PARTS
                before = _letters.stretches(self.sums, starts, starts + a)
                after = _letters.stretches(self.sums, ends - (n - b), ends)
                tag = n.astype(np.uint64) * np.uint64(2 * PARTS) + np.uint64(part)
                key = mixed(mixed(before + tag) ^ (after * np.uint64(0xA0761D6478BD642F)))
                yield a, b + shorter, key

    def variants(self, line: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the line without the character at each place, as a string and with the place."""
        start, end = self.starts[line], self.ends[line]
        sums, inverses = self.sums, _letters.inverses
        at = start + places
        before = (sums[at] - sums[start]) * inverses[start]
        after = (sums[end] - sums[at + 1]) * inverses[start + 1]
        whole = mixed(before + after + np.uint64(end - start - 1))
        return whole, mixed(whole ^ mixed(places.astype(np.uint64) + np.uint64(77)))


def within_one_edit(a: str, b: str) -> bool:
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[i + 1 :] == b[i + (len(a) == len(b)) :]


def _blocks(batches):
    """(ids, keys, texts) of a few texts at a time."""
    for batch in small(batches):
        ids, texts, keys = (batch.column(i).to_pylist() for i in range(3))
        first, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= BLOCK or i == len(texts) - 1:
                yield ids[first : i + 1], keys[first : i + 1], texts[first : i + 1]
                first, size = i + 1, 0


def shared_parts(docs: DataFrame, stage: Stage, min_chars: int) -> np.ndarray:
    """Bitmap of part hashes that at least two different lines have."""

    def parts(batches):
        for _, _, texts in _blocks(batches):
            lines = Lines(texts)
            chosen = np.flatnonzero(lines.sizes >= min_chars)
            # One of each line in the block.
            chosen = chosen[np.unique(lines.keys[chosen], return_index=True)[1]]
            keys = [key for _, _, key in lines.part_keys(chosen)]
            own = np.tile(lines.keys[chosen].view(np.int64), len(keys))
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array(np.concatenate(keys).view(np.int64)), "line": pa.array(own)}
            )
        give_back()

    cell = F.shiftrightunsigned("part", 64 - BITS)
    shared = (
        docs.mapInArrow(parts, "part bigint, line bigint")
        .groupBy("part")
        .agg(F.min("line").alias("a"), F.max("line").alias("b"))
        .filter("a <> b")
        .select(cell.alias("cell"))
    )
    return cell_bitmap(shared, BITS, stage)


LINES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("number", pa.int32()),
        ("key", pa.int64()),
        ("second", pa.int64()),
        ("line", pa.string()),
        ("parts", pa.list_(pa.int64())),
    ]
)


def hashed_lines(docs: DataFrame, stage: Stage, min_chars: int) -> DataFrame:
    """Every line that is not empty, with text and part hashes where the bitmap has one of these."""
    bitmap = docs.sparkSession.sparkContext.broadcast(shared_parts(docs, stage, min_chars))

    def rows(batches):
        seen: set[int] = set()
        for ids, keys, texts in _blocks(batches):
            lines = Lines(texts)
            chosen = np.flatnonzero(lines.sizes >= min_chars)
            passed: dict[int, list[int]] = {}
            for _, _, key in lines.part_keys(chosen):
                hits = np.flatnonzero(flagged(bitmap.value, key >> np.uint64(64 - BITS)))
                for line, part in zip(chosen[hits].tolist(), key[hits].view(np.int64).tolist()):
                    passed.setdefault(line, []).append(part)
            own = lines.keys.view(np.int64)
            held = np.flatnonzero(lines.sizes > 0)
            line_texts, line_parts = [None] * len(held), [None] * len(held)
            for at in np.flatnonzero(np.isin(held, np.array(list(passed), dtype=np.int64))).tolist():
                line = int(held[at])
                if int(own[line]) in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(int(own[line]))
                line_texts[at] = lines.text[lines.starts[line] : lines.ends[line]]
                line_parts[at] = passed[line]
            owners = pa.array(lines.owner[held])
            columns = [
                pa.array(ids, pa.int64()).take(owners),
                pa.array(keys, pa.int64()).take(owners),
                lines.number[held].astype(np.int32),
                own[held],
                lines.second.view(np.int64)[held],
                line_texts,
                line_parts,
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, type=field.type) for column, field in zip(columns, LINES)], schema=LINES
            )
        give_back()

    ddl = (
        "doc_id bigint, text_key bigint, number int, key bigint, second bigint, line string, "
        "parts array<bigint>"
    )
    return docs.mapInArrow(rows, ddl)


def _string_hash(lines: Lines, line: int) -> np.ndarray:
    start, end = lines.starts[line], lines.ends[line]
    whole = (lines.sums[end : end + 1] - lines.sums[start]) * _letters.inverses[start]
    return whole + np.uint64(end - start)


def candidates(lines: DataFrame, firsts: DataFrame, stage: Stage) -> DataFrame:
    """Different lines that share a part with another one, and those parts, as a table.

    Their ``rank`` is the order of their first places. The bitmap passes the more lines without
    a shared part the larger the corpus is, so parts are compared whole here.
    """
    texts = (
        lines.filter("line is not null")
        .groupBy("key", "second")
        .agg(F.first("line").alias("line"), F.first("parts").alias("parts"))
    )
    texts = stage.table(texts, "texts", "zstd")
    parts = texts.select("key", "second", F.explode("parts").alias("part"))
    shared = parts.groupBy("part").agg(F.count("*").alias("n")).filter("n > 1").select("part")
    own = parts.join(shared, "part").groupBy("key", "second").agg(F.collect_list("part").alias("parts"))
    own = stage.table(own.join(firsts, ["key", "second"]), "shared", "zstd")
    # Ids increase from one sorted partition to the next, and each place holds one line.
    ranked = (
        texts.select("key", "second", "line")
        .join(own, ["key", "second"])
        .orderBy("first.doc_id", "first.text_key", "first.number")
        .select(F.monotonically_increasing_id().alias("rank"), "key", "second", "line", "parts")
    )
    ranked = stage.table(ranked, "ranked", "zstd")
    stage.drop_table(texts, own)
    return ranked


ITSELF, WHOLE, PLACED = range(3)
VARIANTS = pa.schema([("hash", pa.int64()), ("kind", pa.int8()), ("rank", pa.int64())])


def variants(ranked: DataFrame) -> DataFrame:
    """(hash, kind, rank): each line itself, and without a character of its shared parts' places."""

    def rows(batches):
        for ranks, shared, texts in _blocks(batches):
            lines = Lines(texts)
            ranges: list[list[np.ndarray]] = [[] for _ in texts]
            for a, b, key in lines.part_keys(np.arange(len(texts))):
                for line, part in enumerate(key.view(np.int64).tolist()):
                    if part in shared[line]:
                        ranges[line].append(np.arange(a[line], b[line]))
            for line, rank in enumerate(ranks):
                whole, placed = lines.variants(line, np.unique(np.concatenate(ranges[line])))
                hashes = mixed(_string_hash(lines, line)), np.unique(whole), placed
                sizes = [len(h) for h in hashes]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(hashes).view(np.int64)),
                        pa.array(np.repeat(np.array([ITSELF, WHOLE, PLACED], dtype=np.int8), sizes)),
                        pa.array(np.full(sum(sizes), rank, dtype=np.int64)),
                    ],
                    schema=VARIANTS,
                )
        give_back()

    # A small table of lines is a large one of variants, so it is dealt over all tasks.
    tasks = int(ranked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranked.select("rank", "line", "parts").repartition(tasks, "rank")
    return dealt.mapInArrow(rows, "hash bigint, kind tinyint, rank bigint")


def near_lines(lines: DataFrame, firsts: DataFrame, stage: Stage) -> DataFrame:
    """(key, second) of lines with an earlier one within one edit, as a table."""
    ranked = candidates(lines, firsts, stage)
    # A line meets its deletion variants' owners and the other way round, and lines that differ
    # in the character at one place. The lines are different, so a hash has few.
    of_hash = Window.partitionBy("hash")
    first_of = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("rank"))).over(of_hash)
    other = (
        F.when(F.col("kind") == ITSELF, first_of(WHOLE))
        .when(F.col("kind") == WHOLE, first_of(ITSELF))
        .otherwise(first_of(PLACED))
    )
    pairs = variants(ranked).select("rank", other.alias("other")).filter("other < rank").distinct()
    pairs = stage.table(pairs, "pairs", "zstd")
    verified = pa.schema([("key", pa.int64()), ("second", pa.int64())])

    def verify(batches):
        def rows():
            for batch in small(batches):
                for key, second, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                    if within_one_edit(a, b):
                        yield key, second

        return batches_of(rows(), verified)

    of_other = ranked.select(F.col("rank").alias("other"), F.col("line").alias("other_line"))
    near = (
        pairs.join(ranked.select("rank", "key", "second", "line"), "rank")
        .join(of_other, "other")
        .select("key", "second", "line", "other_line")
        .mapInArrow(verify, "key bigint, second bigint")
        .distinct()
    )
    near = stage.table(near, "near", "zstd")
    stage.drop_table(pairs, ranked)
    return near


def removed_lines(docs: DataFrame, stage: Stage, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_key, number) of the lines that go; ``docs`` as of ``with_key``."""
    lines = stage.table(hashed_lines(docs, stage, min_chars), "lines", "zstd")
    firsts = lines.groupBy("key", "second").agg(F.min(F.struct("doc_id", "text_key", "number")).alias("first"))
    firsts = stage.table(firsts, "firsts", "zstd")
    near = near_lines(lines, firsts, stage)
    judged = firsts.join(near.withColumn("near", F.lit(True)), ["key", "second"], "left")
    same = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_key") == F.col("text_key"))
    gone = lines.join(judged, ["key", "second"]).filter(F.col("near") | ~same | (F.col("first.number") != F.col("number")))
    gone = stage.table(gone.select("doc_id", "text_key", "number"), "gone", "zstd")
    stage.drop_table(lines, firsts, near)
    return gone


def remove_lines(
    docs: DataFrame,
    stage: Stage,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, kept (text of the lines that stay)."""
    plain = with_key(docs, id_col, text_col)
    gone = removed_lines(plain, stage, min_chars).groupBy(
        F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key")
    ).agg(F.collect_set("number").alias("gone"))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]
    )

    def cut(batches):
        def rows():
            for batch in small(batches):
                for doc_id, text, gone in zip(*(c.to_pylist() for c in batch.columns)):
                    lines, out = text.split("\n"), set(gone or ())
                    kept = [line for i, line in enumerate(lines) if i not in out]
                    yield doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)

        yield from batches_of(rows(), schema, 256)
        give_back()

    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key"))
    joined = plain.join(gone, same, "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(cut, "doc_id bigint, n_lines bigint, n_removed bigint, kept string")


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_AT_ONCE)
    cut = remove_lines(read(spark, folder, "documents"), Stage(spark))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = {
    "op8_line_dedup": r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
), places AS (
    SELECT row_id, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS number FROM texts
), numbered AS (
    SELECT *, row_number() OVER (ORDER BY doc_id, row_id, number) AS line_no FROM places
), firsts AS (
    SELECT line, min(line_no) AS first_at FROM numbered WHERE line <> '' GROUP BY line
), variants AS (
    SELECT line, first_at, place, substr(line, 1, place - 1) || substr(line, place + 1) AS variant
    FROM (SELECT *, unnest(range(1, length(line) + 1)) AS place FROM firsts)
), by_variant AS (
    SELECT variant, min(first_at) AS earliest FROM variants GROUP BY variant
), near AS (
    SELECT firsts.line FROM firsts JOIN by_variant ON variant = firsts.line WHERE earliest < first_at
    UNION
    SELECT variants.line FROM variants JOIN firsts ON variant = firsts.line WHERE firsts.first_at < variants.first_at
    UNION
    SELECT line
    FROM (SELECT line, first_at, min(first_at) OVER (PARTITION BY place, variant) AS earliest FROM variants)
    WHERE earliest < first_at
), judged AS (
    SELECT numbered.*, first_at IS NOT NULL AND (first_at < line_no OR near.line IS NOT NULL) AS gone
    FROM numbered LEFT JOIN firsts ON numbered.line = firsts.line LEFT JOIN near ON numbered.line = near.line
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '')) AS kept_sha256
FROM judged
GROUP BY row_id
"""
}
