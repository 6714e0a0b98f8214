"""Benchmark decontamination by one Aho-Corasick automaton over the normalised test items.

Items are cut into windows of 13 words (shorter items are one window), words being lower-cased
letters A-Z, digits and everything beyond ASCII. The automaton holds the windows of all items,
and each document is scanned once in its normalised form. Hits are mapped back to words and to
characters of the original text.

Items go through the driver, as an automaton must be one whole; each task builds it, in less than a second for a
block, and frees it, since workers live on through later stages.
Their size is measured first: above ``block_bytes`` the items are dealt into blocks, and the rows go
from one block's automaton to the next, with the hits so far, over a written table. So memory is
bounded, no item is left out, and a row stays one row, whatever its id.

Null texts and texts without words have no windows and no hits. Repeated items count once for
each item id; passages of an item without an id are hit and name no item. Other columns stay as they
are; names that start with ``__siftwork_`` are taken. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftwork.llm.common import as_binary, id_and_text, read, runs_of, small
from siftwork.plans.stage import Stage

WINDOW = 13
#: A document is contaminated if at least this share of its words is hit: 1 in 20.
SHARE = 20
#: Text of the items that one automaton may hold; it has some thirteen nodes for each byte.
BLOCK_BYTES = 4 << 20

#: Bytes of a word as they are, letters A-Z lower-cased, all others a space.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

N_WORDS, HIT, ITEMS = "__siftwork_n_words", "__siftwork_hit_words", "__siftwork_items"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def windows_of(words: list[bytes], width: int = WINDOW) -> list[list[bytes]]:
    if not words:
        return []
    return [words[i : i + width] for i in range(max(1, len(words) - width + 1))]


def automaton_of(items: list[tuple[str | None, bytes]], width: int = WINDOW):
    """The automaton, with (words of the window, ids of its items) at each of its words' ends."""
    import ahocorasick

    owners: dict[str, tuple[int, set[str]]] = {}
    for item_id, text in items:
        for window in windows_of(words_of(text), width):
            key = (b" " + b" ".join(window) + b" ").decode("latin-1")
            named = owners.setdefault(key, (len(window), set()))[1]
            if item_id is not None:
                named.add(item_id)
    automaton = ahocorasick.Automaton()
    for key, (n_words, ids) in owners.items():
        automaton.add_word(key, (len(key), n_words, sorted(ids)))
    if owners:
        automaton.make_automaton()
    return automaton if owners else None


def scan(text: bytes, automaton) -> tuple[int, set[int], set[str]]:
    """(number of words, places of words hit, ids of the items found)."""
    words = words_of(text)
    if automaton is None or not words:
        return len(words), set(), set()
    line = b" " + b" ".join(words) + b" "
    hit, items, at, word = set(), set(), 0, 0
    for end, (length, n_words, ids) in automaton.iter(line.decode("latin-1")):
        start = end - length + 1
        # The space at ``start`` is the one before the window's first word.
        word += line.count(b" ", at, start) if start >= at else -line.count(b" ", start, at)
        at = start
        hit.update(range(word, word + n_words))
        items.update(ids)
    return len(words), hit, items


def _spans(text: str, hit_words: list[int]) -> list[tuple[int, int]]:
    places = [m.span() for m in WORD.finditer(_lower(text))]
    numbers = np.array(hit_words)
    firsts, lasts = runs_of(numbers - np.arange(len(numbers)))
    return [(places[numbers[a]][0], places[numbers[b - 1]][1]) for a, b in zip(firsts, lasts)]


_LOWER = {c: c + 32 for c in range(65, 91)}


def _lower(text: str) -> str:
    return text.translate(_LOWER)


def _blocks(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-int(size) * 2 // block_bytes)) if size > block_bytes else 1
    if n == 1:
        return [items]
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) for b in range(n)]


def scan_rows(
    docs: DataFrame,
    items: DataFrame,
    stage: Stage,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` as they are, with n_words, hit_words and items under ``__siftwork_`` names.

    A row stays one row, however many blocks there are; it goes from one block's scan to the next.
    """
    plain = items.select(
        items[item_id_col].cast("string").alias("item_id"),
        F.coalesce(items[item_text_col].cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    rows = docs.select(
        "*",
        F.lit(0).cast("bigint").alias(N_WORDS),
        F.array().cast("array<int>").alias(HIT),
        F.array().cast("array<string>").alias(ITEMS),
    )
    place = docs.columns.index(text_col)
    blocks = _blocks(plain, block_bytes)
    for number, block in enumerate(blocks):
        # The items of one block at a time; ``block_bytes`` bounds them.
        held = sorted(((row.item_id, bytes(row.text)) for row in block.collect()), key=repr)
        rows = rows.mapInArrow(_scanner(docs.sparkSession.sparkContext.broadcast(held), width, place), rows.schema)
        if number + 1 < len(blocks):
            rows = stage.table(rows, "scanned", "zstd")
    return rows


def _scanner(items, width: int, place: int):
    def scan_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(items.value, width)
        for batch in small(batches):
            texts = as_binary(batch.column(place))
            n_words, hits, names = [], [], []
            before = zip(batch.column(HIT).to_pylist(), batch.column(ITEMS).to_pylist())
            for i, (had, named) in enumerate(before):
                n, hit, ids = scan(texts[i].as_py() or b"", automaton)
                n_words.append(n)
                hits.append(sorted(hit.union(had)))
                names.append(sorted(ids.union(named)))
            columns = batch.columns[:-3]
            columns += [pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return scan_all


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    stage: Stage,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options: object,
) -> DataFrame:
    """Per document: doc_id, n_words, hit_words (places), items. Options are those of ``scan_rows``."""
    return scan_rows(id_and_text(docs, id_col, text_col), items, stage, **options).select(
        "doc_id", F.col(N_WORDS).alias("n_words"), F.col(HIT).alias("hit_words"), F.col(ITEMS).alias("items")
    )


def find_spans(docs: DataFrame, items: DataFrame, stage: Stage, text_col: str = "text", **options: object) -> DataFrame:
    """The rows of ``docs`` with ``spans``, the hit stretches in characters of the original text."""
    rows = scan_rows(docs, items, stage, text_col, **options)

    place = docs.columns.index(text_col)

    def spans(batches):
        for batch in small(batches):
            texts, hits = batch.column(place).to_pylist(), batch.column(HIT).to_pylist()
            found = [[{"start": a, "end": b} for a, b in _spans(t, h)] if h else [] for t, h in zip(texts, hits)]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(found, kind)], [*batch.schema.names[:-3], "spans"])

    added = StructType.fromDDL("spans array<struct<start: int, end: int>>")
    return rows.mapInArrow(spans, StructType([*docs.schema.fields, *added.fields]))


def judged(hits: DataFrame, share: int = SHARE) -> DataFrame:
    """Counts and the contamination flag of the documents of ``find_hits``."""
    return hits.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.size("hit_words") > 0) & (share * F.size("hit_words") >= F.col("n_words"))).alias(
            "contaminated"
        ),
    )


def keep_clean(docs: DataFrame, items: DataFrame, stage: Stage, share: int = SHARE) -> DataFrame:
    """The documents that are not contaminated, with all their columns; decided where they are scanned."""
    n_hit = F.size(HIT)
    contaminated = (n_hit > 0) & (share * n_hit >= F.col(N_WORDS))
    return scan_rows(docs, items, stage).filter(~contaminated).select(*docs.columns)


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    return judged(find_hits(docs, items, Stage(spark)))


ORACLE = {
    "op6_decontamination": r"""
WITH item_words AS (
    SELECT row_number() OVER () AS item_row, item_id,
           list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM benchmark
), item_windows AS (
    SELECT item_id, n, array_to_string(words[place:place + n - 1], ' ') AS window_text
    FROM (SELECT *, least(len(words), 13) AS n, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS place
          FROM item_words WHERE len(words) > 0)
), widths AS (
    SELECT DISTINCT n FROM item_windows
), texts AS (
    SELECT row_number() OVER () AS row_id, doc_id,
           list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM documents
), windows AS (
    SELECT row_id, n, place, array_to_string(words[place:place + n - 1], ' ') AS window_text
    FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS place FROM texts, widths WHERE len(words) >= n)
), found AS (
    SELECT row_id, item_id, place, n FROM windows JOIN item_windows USING (n, window_text)
), hits AS (
    SELECT row_id, count(DISTINCT word) AS n_hit
    FROM (SELECT row_id, unnest(range(place, place + n)) AS word FROM found)
    GROUP BY row_id
), named AS (
    SELECT row_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item_id FROM found)
    GROUP BY row_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM texts LEFT JOIN hits USING (row_id) LEFT JOIN named USING (row_id)
"""
}
