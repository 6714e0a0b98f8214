"""Repeated byte strings by longest-previous-factor arrays over suffixes in order.

A string of 200 bytes that starts at several places of the corpus is found in three steps. Runs of
windows (``window_runs``) whose fingerprint occurs once are ruled out with a bitmap of counts. Runs
of equal content are repeated as a whole. What differs within a fingerprint, the ends of repeated
passages, goes to buckets, and each bucket sorts its suffixes: equal strings have equal
fingerprints and so share a bucket, and no suffix is needed beyond 200 bytes.

In a bucket, the previous and the next smaller position in suffix order are the two places before
a suffix that share the longest prefix with it. The longer one is its longest previous factor;
the same from the other end gives the longest next factor. A string is repeated if either
reaches its length, and it has an earlier copy if the previous factor does.

Fingerprints with very many different surroundings are dealt over several buckets by the hash of
the string, which equal strings share; so no bucket depends on one passage. Matches never cross
documents. Null and empty texts have no bytes. Repeated ids are told apart by their text; identical
rows are copies of each other. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm.common import (
    BYTE_VALUES,
    as_binary,
    batches_of,
    cell_bitmap,
    flagged,
    read,
    records,
    repeated_cells,
)
from siftwork.llm.substring_dedup import marked, spans_by_text, with_key
from siftwork.llm.window_runs import cells_of, window_runs
from siftwork.plans.stage import Stage

WINDOW = 200
#: Bytes of the stretches from which a window's fingerprint is taken.
GRAM = 32
#: Cells of the bitmap of fingerprints.
BITS = 26
#: Suffixes that a bucket is meant to hold, and those of one fingerprint in one bucket.
BUCKET, SHARE = 60_000, 30_000

FLAGGED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("anchor", pa.int64()),
        ("content", pa.int64()),
        ("start", pa.int32()),
        ("n_windows", pa.int32()),
        ("itself", pa.bool_()),
        ("bytes", pa.binary()),
    ]
)
FLAGGED_DDL = (
    "doc_id bigint, text_key bigint, anchor bigint, content bigint, start int, n_windows int, "
    "itself boolean, bytes binary"
)


def _runs(text: bytes, width: int, gram: int):
    return window_runs(BYTE_VALUES[np.frombuffer(text, dtype=np.uint8)], width, gram)


def repeated_anchors(docs: DataFrame, stage: Stage, width: int, gram: int) -> np.ndarray:
    def cells(batches):
        for batch in batches:
            found = [np.zeros(0, dtype=np.uint64)]
            for _, text in records([batch]):
                runs = _runs(text, width, gram)
                if runs is not None:
                    own = cells_of(runs.anchors, BITS)
                    found += [own, own[runs.repeats_itself]]
            cell = np.concatenate(found).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(cell)})

    return repeated_cells(docs.mapInArrow(cells, "cell bigint"), BITS, stage)


def flagged_runs(docs: DataFrame, stage: Stage, width: int, gram: int) -> DataFrame:
    bitmap = docs.sparkSession.sparkContext.broadcast(repeated_anchors(docs, stage, width, gram))

    def keep(batches):
        def rows():
            for batch in batches:
                keys = batch.column(2).to_pylist()
                for (doc_id, text), key in zip(records([batch]), keys):
                    runs = _runs(text, width, gram)
                    if runs is None:
                        continue
                    chosen = np.flatnonzero(flagged(bitmap.value, cells_of(runs.anchors, BITS)))
                    contents = runs.contents(chosen).view(np.int64).tolist()
                    anchors = runs.anchors[chosen].view(np.int64).tolist()
                    starts, ends = runs.starts[chosen].tolist(), runs.ends[chosen].tolist()
                    itself = runs.repeats_itself[chosen].tolist()
                    for a, c, s, e, twice in zip(anchors, contents, starts, ends, itself):
                        yield doc_id, key, a, c, s, e - s, twice, text[s : e - 1 + width]

        return batches_of(rows(), FLAGGED)

    return docs.mapInArrow(keep, FLAGGED_DDL)


def factor_lengths(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(longest previous, longest next factor) of each row, rows being suffixes by position.

    Suffixes are sorted, and neighbours' common prefixes give those of any two as a minimum. The
    nearest smaller positions on both sides come from pointers that jump over larger ones.
    """
    n, width = strings.shape
    if n < 2:
        return np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    order = np.argsort(np.ascontiguousarray(strings).view(f"V{width}").ravel(), kind="stable")
    ranked = strings[order]
    differs = ranked[1:] != ranked[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    previous, following = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    previous[order] = _nearest_before(order, common)
    following[order] = _nearest_before(-order, common)
    return previous, following


def _nearest_before(positions: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For suffixes in order, the longest prefix shared with one of a smaller position."""
    up = _prefix_to_smaller(positions, np.concatenate(([0], common)))
    down = _prefix_to_smaller(positions[::-1], np.concatenate(([0], common[::-1])))
    return np.maximum(up, down[::-1])


def _prefix_to_smaller(positions: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Prefix shared with the nearest smaller position before; ``shared`` is that with the last.

    All between a pointer and its owner are larger than the owner. A pointer to a larger one may
    therefore move on to where that one points.
    """
    pointer = np.arange(len(positions)) - 1
    shared = shared.copy()
    moving = np.arange(len(positions))
    while len(moving):
        at = pointer[moving]
        moving = moving[(at >= 0) & (positions[at] > positions[moving])]
        at = pointer[moving]
        shared[moving] = np.minimum(shared[moving], shared[at])
        pointer[moving] = pointer[at]
    return np.where(pointer >= 0, shared, 0)


def _dealt(edges: DataFrame, width: int) -> DataFrame:
    """Edge runs with their bucket and, where a fingerprint has several, the windows for it."""
    fields = [("doc_id", pa.int64()), ("text_key", pa.int64()), ("start", pa.int32())]
    fields += [("bytes", pa.binary()), ("offsets", pa.list_(pa.int32())), ("bucket", pa.int64())]
    schema = pa.schema(fields)

    def deal(batches):
        def rows():
            for batch in batches:
                *given, anchors, shares = (batch.column(i).to_pylist() for i in range(6))
                for doc_id, key, start, text, anchor, n in zip(*given, anchors, shares):
                    n_windows = len(text) - width + 1
                    if n == 1:
                        yield doc_id, key, start, text, list(range(n_windows)), anchor
                        continue
                    strings = np.lib.stride_tricks.sliding_window_view(
                        np.frombuffer(text, dtype=np.uint8), width
                    )
                    part = np.array(
                        [
                            int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little") % n
                            for s in strings
                        ]
                    )
                    for share in np.unique(part).tolist():
                        where = np.flatnonzero(part == share).tolist()
                        yield doc_id, key, start, text, where, (anchor + share * 0x9E3779B1) & (2**63 - 1)

        return batches_of(rows(), schema, 256)

    ddl = (
        "doc_id bigint, text_key bigint, start int, bytes binary, offsets array<int>, "
        "bucket bigint"
    )
    return edges.mapInArrow(deal, ddl)


def repeated_spans(
    docs: DataFrame, stage: Stage, width: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Spans (doc_id, text_key, start, end), in bytes, of strings that start anywhere else too.

    ``docs`` has the columns of ``with_key``.
    """
    runs = flagged_runs(docs, stage, width, gram).withColumn("run", F.monotonically_increasing_id())
    runs = stage.table(runs, "runs", "zstd")
    contents = stage.table(
        runs.groupBy("anchor", "content").agg(
            F.count("*").alias("n"),
            F.min("run").alias("head"),
            F.max("n_windows").alias("n_windows"),
            F.max("itself").alias("itself"),
        ),
        "contents", "zstd",
    )
    repeated = contents.filter("n > 1").select("anchor", "content")
    whole = (
        runs.select("anchor", "content", "doc_id", "text_key", "start", "n_windows")
        .join(repeated, ["anchor", "content"])
        .select("doc_id", "text_key", "start", (F.col("start") + F.col("n_windows") + width - 1).alias("end"))
    )
    several = (
        contents.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.sum("n_windows").alias("windows"), F.max("itself").alias("itself"))
        .filter("n > 1 or itself")
        .select("anchor", F.ceil(F.col("windows") / SHARE).cast("int").alias("shares"), "windows")
    )
    several = stage.table(several, "several", "zstd")
    heads = contents.join(several, "anchor").select(F.col("head").alias("run"), "shares")
    total = several.agg(F.sum("windows")).first()[0] or 0
    buckets = max(1, -(-int(total) // BUCKET))
    # Only the heads' bytes are moved: a bitmap of fixed size drops most other runs before.
    cell = F.shiftrightunsigned(F.xxhash64("run"), 64 - BITS)
    bitmap = docs.sparkSession.sparkContext.broadcast(
        cell_bitmap(heads.select(cell.alias("cell")), BITS, stage)
    )

    def is_head(batches):
        for batch in batches:
            cells = batch.column("cell").to_numpy().astype(np.uint64)
            yield batch.filter(pa.array(flagged(bitmap.value, cells)))

    likely = runs.select("run", "doc_id", "text_key", "start", "bytes", "anchor", cell.alias("cell"))
    edges = (
        likely.mapInArrow(is_head, likely.schema)
        .join(heads, "run")
        .select("doc_id", "text_key", "start", "bytes", "anchor", "shares")
    )
    dealt = _dealt(edges, width).withColumn("bucket", F.pmod(F.xxhash64("bucket"), F.lit(buckets)))
    ends = dealt.groupBy("bucket").applyInArrow(
        _bucket_spans(width), "doc_id bigint, text_key bigint, spans array<struct<start: int, end: int>>"
    )
    return whole.union(ends.selectExpr("doc_id", "text_key", "inline(spans)"))


def _spans(places: np.ndarray, width: int) -> list[dict[str, int]]:
    """Starts of windows as stretches, joined where windows meet or overlap."""
    cuts = np.flatnonzero(np.diff(places) > width) + 1
    firsts, lasts = places[np.append(0, cuts)], places[np.append(cuts, len(places)) - 1]
    return [{"start": int(a), "end": int(b) + width} for a, b in zip(firsts, lasts)]


def _bucket_spans(width: int):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("spans", pa.list_(span))])

    def find(table: pa.Table) -> pa.Table:
        ids, keys = table["doc_id"].to_pylist(), table["text_key"].to_pylist()
        firsts, texts = table["start"].to_pylist(), table["bytes"].to_pylist()
        offsets = [np.array(x, dtype=np.int64) for x in table["offsets"].to_pylist()]
        view = np.lib.stride_tricks.sliding_window_view
        strings = np.concatenate(
            [view(np.frombuffer(t, dtype=np.uint8), width)[o] for t, o in zip(texts, offsets)]
        )
        previous, following = factor_lengths(strings)
        repeated = np.maximum(previous, following) >= width
        out, at = [], 0
        for i, own in enumerate(offsets):
            places = own[repeated[at : at + len(own)]]
            at += len(own)
            if len(places):
                out.append((ids[i], keys[i], _spans(places + firsts[i], width)))
        columns = zip(*out) if out else [[], [], []]
        return pa.Table.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
        )

    return find


def remove_repeats(
    docs: DataFrame,
    stage: Stage,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WINDOW,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (remaining bytes).

    ``kept`` is binary: a removed string may begin or end within a character.
    """
    plain = with_key(docs, id_col, text_col)
    spans = spans_by_text(repeated_spans(plain, stage, width))
    fields = [(n, pa.int64()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")]
    schema = pa.schema([*fields, ("kept", pa.binary())])

    def cut(batches):
        def rows():
            for batch in batches:
                texts, spans = as_binary(batch.column(1)), batch.column(2)
                for i, doc_id in enumerate(batch.column(0).to_pylist()):
                    text, found = texts[i].as_py(), spans[i].as_py()
                    if not found:
                        yield doc_id, len(text), 0, 0, text
                        continue
                    gone = marked(found, len(text))
                    kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    yield doc_id, len(text), len(text) - len(kept), n_spans, kept

        return batches_of(rows(), schema, 256)

    joined = plain.join(
        spans, (F.col("doc_id") == F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left"
    ).select("doc_id", "text", "spans")
    return joined.mapInArrow(
        cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = remove_repeats(read(spark, folder, "documents"), Stage(spark))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


ORACLE = {
    "op5_suffix_dedup": r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_id, doc_id, encode(coalesce(text, '')) AS bytes FROM documents
), starts AS (
    SELECT row_id, start
    FROM (SELECT row_id, start, count(*) OVER (PARTITION BY string) AS n
          FROM (SELECT row_id, start, bytes[start + 1:start + 200] AS string
                FROM (SELECT *, unnest(range(octet_length(bytes) - 199)) AS start FROM texts)))
    WHERE n > 1
), edges AS (
    SELECT *, lag(start) OVER (PARTITION BY row_id ORDER BY start) AS before FROM starts
), runs AS (
    SELECT row_id, min(start) AS first, max(start) + 200 AS past
    FROM (SELECT *, sum(CASE WHEN before IS NULL OR start > before + 200 THEN 1 ELSE 0 END)
                        OVER (PARTITION BY row_id ORDER BY start) AS run FROM edges)
    GROUP BY row_id, run
), gaps AS (
    SELECT row_id, coalesce(lag(past) OVER (PARTITION BY row_id ORDER BY first), 0) AS a, first AS b, past - first AS size
    FROM runs
    UNION ALL
    SELECT row_id, coalesce(max(past), 0), any_value(octet_length(bytes)), 0
    FROM texts LEFT JOIN runs USING (row_id)
    GROUP BY row_id
)
SELECT any_value(doc_id) AS doc_id, any_value(octet_length(bytes)) AS n_bytes, sum(size)::BIGINT AS n_removed,
       count(*) - 1 AS n_spans, sha256(unhex(string_agg(hex(bytes[a + 1:b]), '' ORDER BY a, b))) AS kept_sha256
FROM texts JOIN gaps USING (row_id)
GROUP BY row_id
"""
}
