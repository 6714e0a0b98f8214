"""Removal of passages that an earlier document holds, with a count-min prefilter.

A passage is a window of 50 words. First, every partition sketches how often the fingerprints of
its windows occur, two count-min cells each; the merged sketch overestimates the counts of
windows and is kept as a bitmap of fixed size. A second pass over the texts keeps only windows
whose both cells say "more than once", so no repeated window is lost, and groups those exactly:
by run of windows where whole runs are the same, by single windows where they differ
(``window_runs``). A word goes if it lies in a window that also starts in a document of smaller id.

Windows are judged on the input. Null texts have no words; texts of fewer words than a window stay
whole. Documents that share an id don't remove from each other. Other columns are not read. Windows
are compared by two independent 64-bit hashes. With corpora far beyond the sketch's cells the
prefilter passes more windows than needed, which costs time and changes no result.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm.common import (
    as_binary,
    batches_of,
    flagged,
    id_and_text,
    read,
    records,
    repeated_cells,
    union_length,
    word_hashes,
)
from siftwork.llm.window_runs import cells_of, window_runs
from siftwork.plans.stage import Stage

WINDOW = 50
#: Words of the stretches from which a window's fingerprint is taken.
GRAM = 6
#: Count-min rows of 2**BITS cells.
ROWS, BITS = 2, 25

FLAGGED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("anchor", pa.int64()),
        ("content", pa.int64()),
        ("start", pa.int32()),
        ("windows", pa.list_(pa.int64())),
    ]
)


def with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a hash of the text, which tells rows of one id apart."""
    return id_and_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))


def sketch(docs: DataFrame, stage: Stage, width: int, gram: int) -> np.ndarray:
    def cells(batches):
        for batch in batches:
            found = [np.zeros(0, dtype=np.uint64)]
            for _, text in records([batch]):
                runs = window_runs(word_hashes(text), width, gram)
                if runs is not None:
                    anchors = np.unique(runs.anchors)
                    found += [cells_of(anchors, BITS, row) for row in range(ROWS)]
            cell = np.concatenate(found).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(cell)})

    return repeated_cells(docs.mapInArrow(cells, "cell bigint"), BITS + ROWS - 1, stage)


def flagged_runs(docs: DataFrame, stage: Stage, width: int, gram: int) -> DataFrame:
    """Runs whose windows are estimated to occur more than once, with their window hashes."""
    bitmap = docs.sparkSession.sparkContext.broadcast(sketch(docs, stage, width, gram))

    def keep(batches):
        def rows():
            for batch in batches:
                keys = batch.column(2).to_pylist()
                for (doc_id, text), key in zip(records([batch]), keys):
                    runs = window_runs(word_hashes(text), width, gram)
                    if runs is None or doc_id is None:
                        continue
                    repeated = np.ones(len(runs.anchors), dtype=bool)
                    for row in range(ROWS):
                        repeated &= flagged(bitmap.value, cells_of(runs.anchors, BITS, row))
                    chosen = np.flatnonzero(repeated)
                    if not len(chosen):
                        continue
                    contents = runs.contents(chosen).view(np.int64).tolist()
                    windows = runs.windows().view(np.int64)
                    for i, content in zip(chosen, contents):
                        start, end = int(runs.starts[i]), int(runs.ends[i])
                        anchor = int(runs.anchors[i].view(np.int64))
                        yield doc_id, key, anchor, content, start, windows[start:end]

        return batches_of(rows(), FLAGGED)

    ddl = (
        "doc_id bigint, text_key bigint, anchor bigint, content bigint, start int, "
        "windows array<bigint>"
    )
    return docs.mapInArrow(keep, ddl)


def repeated_spans(
    docs: DataFrame, stage: Stage, width: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Spans (doc_id, text_key, start, end), in words, that earlier documents hold.

    ``docs`` has the columns of ``with_key``.
    """
    runs = stage.table(flagged_runs(docs, stage, width, gram), "runs", "zstd")
    firsts = runs.groupBy("anchor", "content").agg(F.min("doc_id").alias("first_id"))
    judged = runs.join(firsts, ["anchor", "content"])
    later = judged.filter("doc_id > first_id").select(
        "doc_id", "text_key", "start",
        (F.col("start") + F.size("windows") + width - 1).alias("end"),
    )
    # Runs of one fingerprint and several contents: the windows of the first of each content.
    several = firsts.groupBy("anchor").count().filter("count > 1").select("anchor")
    heads = stage.table(
        judged.filter("doc_id = first_id")
        .join(several, "anchor")
        .select("doc_id", "text_key", "anchor", "start", F.posexplode("windows").alias("i", "window"))
        .select("doc_id", "text_key", "anchor", "window", (F.col("start") + F.col("i")).alias("start")),
        "heads", "zstd",
    )
    first_windows = heads.groupBy("anchor", "window").agg(F.min("doc_id").alias("first_id"))
    single = (
        heads.join(first_windows, ["anchor", "window"])
        .filter("doc_id > first_id")
        .select("doc_id", "text_key", "start", (F.col("start") + width).alias("end"))
    )
    return later.union(single)


def spans_by_text(spans: DataFrame) -> DataFrame:
    """All spans of a text in two arrays; a text has at most as many spans as windows."""
    packed = F.collect_list(F.shiftleft(F.col("start").cast("bigint"), 32) + F.col("end"))
    return spans.groupBy(
        F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key")
    ).agg(packed.alias("spans"))


def marked(spans, n: int) -> np.ndarray:
    """Which of n units lie in the packed spans."""
    packed = np.array(spans or [], dtype=np.int64)
    return union_length(packed >> 32, packed & 0xFFFFFFFF, n)


def remove_repeats(
    docs: DataFrame,
    stage: Stage,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WINDOW,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (text of the words that stay)."""
    plain = with_key(docs, id_col, text_col)
    spans = spans_by_text(repeated_spans(plain, stage, width))
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("n_removed", pa.int64()),
            ("kept", pa.binary()),
        ]
    )

    def cut(batches):
        def rows():
            for batch in batches:
                texts, spans = as_binary(batch.column(1)), batch.column(2)
                for i, doc_id in enumerate(batch.column(0).to_pylist()):
                    words, found = texts[i].as_py().split(), spans[i].as_py()
                    if found:
                        gone = marked(found, len(words))
                        kept = [w for w, out in zip(words, gone.tolist()) if not out]
                    else:
                        kept = words
                    yield doc_id, len(words), len(words) - len(kept), b" ".join(kept)

        return batches_of(rows(), schema, 256)

    joined = plain.join(
        spans, (F.col("doc_id") == F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left"
    ).select("doc_id", "text", "spans")
    ddl = "doc_id bigint, n_words bigint, n_removed bigint, kept binary"
    return joined.mapInArrow(cut, ddl).withColumn("kept", F.col("kept").cast("string"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = remove_repeats(read(spark, folder, "documents"), Stage(spark))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = {
    "op4_substring_dedup": r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_id, doc_id,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), windows AS (
    SELECT row_id, doc_id, place, array_to_string(words[place:place + 49], ' ') AS window_text
    FROM (SELECT *, unnest(range(1, len(words) - 48)) AS place FROM texts)
), repeats AS (
    SELECT row_id, place
    FROM (SELECT *, min(doc_id) OVER (PARTITION BY window_text) AS first_id FROM windows)
    WHERE doc_id > first_id
), removed AS (
    SELECT row_id, list(DISTINCT word) AS gone
    FROM (SELECT row_id, unnest(range(place, place + 50)) AS word FROM repeats)
    GROUP BY row_id
), kept AS (
    SELECT doc_id, words, coalesce(len(gone), 0) AS n_removed,
           CASE WHEN gone IS NULL THEN words
                ELSE list_transform(list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(gone, i)), lambda i: words[i])
           END AS kept_words
    FROM texts LEFT JOIN removed USING (row_id)
)
SELECT doc_id, len(words) AS n_words, n_removed,
       sha256(array_to_string(kept_words, ' ')) AS kept_sha256
FROM kept
"""
}
