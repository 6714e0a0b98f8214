"""Near duplicates by word shingles: T-occurrence search over inverted lists, and components.

Two sets of n and m shingles reach the similarity only if they share T = ceil(s / (1 + s) (n + m))
of them. DivideSkip splits the inverted lists of a document's shingles into the T - 1 longest and
the rest, the short ones: a partner must occur in a short list, and the long lists need not be
merged but are probed for the candidates found. How long a list is comes from a sketch of
document counts; any order of the shingles gives right results, a good one short lists.

Only short lists are built: Spark groups (shingle, document) pairs and merges them by shingle.
Candidates are probed by binary search in their sorted shingles, which is the same as probing
every long list for the candidate. Only lists whose documents could meet are built: the sizes in
each list are counted first, merged on the map side, and a document whose list holds no other one
of about its size drops out, exactly and however large the corpus is.

Links are wanted for components, so a list does not need all its pairs. Each list is first
searched as a star: its members are compared with one of them. Members that are then in one
component are done with, and lists of a single component drop out. Stars around other members
follow while the remaining lists are long and stars still join components; then members of
different components meet in all the lists that are left. That finds every component, and pairs
within a group of copies are never emitted.

Null texts and texts without words have no shingles and no links. Texts with fewer words than a
shingle have one, the whole sequence. Repeated ids are one node. Other columns are not read.
Shingles are compared by 64-bit hashes: for documents of a thousand shingles, the chance that one
pair is misjudged is below 1e-13.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm.common import (
    RollingHashes,
    batches_of,
    cell_bitmap,
    flagged,
    give_back,
    id_and_text,
    read,
    records,
    repeats_ids,
    small,
    word_hashes,
)
from siftwork.llm.components import components
from siftwork.plans.stage import Stage

SHINGLE_WORDS = 4
#: Similarity in hundredths.
SIMILARITY = 85
#: Cells of the sketch of document counts, by which shingles are ordered.
SKETCH_BITS = 21
#: Slices in which the tasks' sketches are added up.
SLICES = 64
#: Cells of the bitmap that tells which documents are in a pair.
CELL_BITS = 26

ROW, NODE = "__siftwork_row", "__siftwork_node"
#: Lists whose pairs are at most so many for each member are searched as a whole.
PAIRS_A_MEMBER = 20

_shingles = RollingHashes(0x9E3779B97F4A7C15)

LISTED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("shingles", pa.list_(pa.int64())),
    ]
)


def shingle_set(text: bytes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = word_hashes(text, lower=True)
    if not len(words):
        return words
    width = min(width, len(words))
    return np.unique(_shingles.windows(_shingles.sums(words), width) + np.uint64(width))


def ceil_share(n: np.ndarray | int, share: int, whole: int):
    return -(-n * share // whole)


def short_lists(shingles: np.ndarray, counts: np.ndarray, similarity: int) -> np.ndarray:
    """The shingles whose lists are short, rarest first: towards any partner T is s * n or more."""
    n = len(shingles)
    cells = shingles & np.uint64(len(counts) - 1)
    order = np.lexsort((shingles, counts[cells]))
    return shingles[order[: n - ceil_share(n, similarity, 100) + 1]]


def document_counts(docs: DataFrame, width: int) -> np.ndarray:
    """Sketch of how many documents hold a shingle: 2**SKETCH_BITS counts, summed slice by slice.

    Tasks count their own documents; a slice of the sketch meets those of the other tasks in one of
    SLICES tasks, which adds them up as they come. The driver gets one finished sketch.
    """
    cells_a_slice = (1 << SKETCH_BITS) // SLICES
    schema = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])

    def sliced(total: np.ndarray, numbers) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array([row.tobytes() for row in total], pa.binary())],
            schema=schema,
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in small(batches):
            for _, text in records([batch]):
                # A text's shingles are distinct, but two of them can share a cell.
                cells = (shingle_set(text, width) & np.uint64(len(total) - 1)).astype(np.int64)
                np.add.at(total, cells, 1)
        if total.any():
            yield sliced(total.reshape(SLICES, -1), range(SLICES))
        del total
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                total = sums.setdefault(number, np.zeros(cells_a_slice, dtype=np.uint64))
                total += np.frombuffer(counts.as_buffer(), dtype=np.uint32)
        if sums:
            held = np.minimum(np.stack(list(sums.values())), 0xFFFFFFFF).astype(np.uint32)
            yield sliced(held, list(sums))

    ddl = "slice int, counts binary"
    summed = docs.mapInArrow(count, ddl).repartition(SLICES, "slice").mapInArrow(add, ddl)
    out = np.zeros((SLICES, cells_a_slice), dtype=np.uint32)
    for row in summed.toLocalIterator():
        out[row.slice] = np.frombuffer(row.counts, dtype=np.uint32)
    return out.reshape(-1)


def build_lists(docs: DataFrame, stage: Stage, width: int, similarity: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, the shingles of its short lists, rarest first."""
    counts = docs.sparkSession.sparkContext.broadcast(document_counts(docs, width))

    def lists(batches):
        def rows():
            for doc_id, text in records(batches):
                shingles = shingle_set(text, width)
                short = short_lists(shingles, counts.value, similarity) if len(shingles) else shingles
                yield doc_id, len(shingles), short.view(np.int64)

        yield from batches_of(rows(), LISTED, 512)
        give_back()

    ddl = "doc_id bigint, n_shingles bigint, shingles array<bigint>"
    return stage.table(docs.mapInArrow(lists, ddl), "lists", "zstd")


def shared_lists(listed: DataFrame, stage: Stage, similarity: int) -> DataFrame:
    """Table of the members of short lists: shingle, doc_id, n_shingles, size_class, place in the order.

    Members of one size class have sizes within the similarity of each other, and a member of another
    size is in the next class at most. A list is summed up by which classes it holds (modulo 64) and
    by whether it has more members than classes; the others of its class and of the next ones are
    all that a member can be linked with.
    """
    log_size = F.log(F.col("n_shingles").cast("double"))
    size_class = F.floor(log_size / float(np.log(100 / similarity))).cast("int")
    items = listed.filter("size(shingles) > 0 and doc_id is not null").select(
        "doc_id", "n_shingles", F.posexplode("shingles").alias("place", "shingle")
    )
    classes = F.bit_or(F.expr("shiftleft(1L, pmod(size_class, 64))"))
    summed = (
        items.select("shingle", size_class.alias("size_class"))
        .groupBy("shingle")
        .agg(classes.alias("classes"), F.count(F.lit(1)).alias("members"))
        .select("shingle", "classes", (F.col("members") > F.bit_count("classes")).alias("crowded"))
    )
    # Classes next to each other, the last and the first of the 64 too.
    neighbours = "classes & (shiftleft(classes, 1) | shiftrightunsigned(classes, 63))"
    shared = stage.key_sets({"shared": summed.filter(f"crowded or {neighbours} <> 0")})["shared"]
    beside = F.expr("shiftleft(1L, pmod(size_class + 1, 64)) | shiftleft(1L, pmod(size_class - 1, 64))")
    members = (
        items.join(shared, "shingle")
        .withColumn("size_class", size_class)
        .filter(F.col("crowded") | (F.col("classes").bitwiseAND(beside) != 0))
        .select("shingle", "doc_id", "n_shingles", "size_class", "place")
    )
    members = stage.table(members, "members", "zstd")
    stage.drop_table(shared)
    return members


def probe(
    pairs: DataFrame, docs: DataFrame, stage: Stage, width: int, similarity: int
) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, as a table; only their documents' texts are moved.

    Which documents these are, all tasks that read texts know from a bitmap of fixed size.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("end")).select(id_cell("end").alias("cell"))
    texts = stage.table(_packed(docs, cell_bitmap(ends, CELL_BITS, stage)), "texts", "uncompressed")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def check(batches):
        unpack = zstandard.ZstdDecompressor().decompress

        def rows():
            last, long_lists = None, None
            for batch in batches:
                a, b, text_a, text_b = (batch.column(i) for i in range(4))
                for i, (one, other) in enumerate(zip(a.to_pylist(), b.to_pylist())):
                    if other != last:
                        long_lists = shingle_set(unpack(text_b[i].as_py()), width)
                        last = other
                    query = shingle_set(unpack(text_a[i].as_py()), width)
                    if similar(query, long_lists, similarity):
                        yield one, other

        return batches_of(rows(), schema)

    of_a = texts.select(F.col("doc_id").alias("a"), F.col("bytes").alias("text_a"))
    of_b = texts.select(F.col("doc_id").alias("b"), F.col("bytes").alias("text_b"))
    joined = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "text_a", "text_b")
    links = stage.table(joined.mapInArrow(check, "a bigint, b bigint"), "links", "zstd")
    stage.drop_table(texts)
    return links


def id_cell(name: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(name), 64 - CELL_BITS)


def _packed(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """doc_id and the compressed text of the documents in the bitmap's cells, where they are read.

    So no text is sent to find out whether it is in a pair. A cell may hold other documents, too; the
    joins with the pairs drop these. Texts travel with pairs, and compression halves what is moved.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("bytes", pa.binary())])
    known = docs.sparkSession.sparkContext.broadcast(bitmap)

    def pack(batches):
        compress = zstandard.ZstdCompressor(level=3, write_checksum=False).compress

        def held():
            for batch in batches:
                cells = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint64)
                yield batch.filter(pa.array(flagged(known.value, cells)))

        yield from batches_of(((i, compress(text)) for i, text in records(held())), schema)
        give_back()

    found = docs.filter("doc_id is not null").select("doc_id", "text", id_cell("doc_id").alias("cell"))
    return found.mapInArrow(pack, "doc_id bigint, bytes binary")


def similar(query: np.ndarray, other: np.ndarray, similarity: int) -> bool:
    n, m = len(query), len(other)
    if not n or not m or 100 * min(n, m) < similarity * max(n, m):
        return False
    places = np.searchsorted(other, query)
    places[places == m] = m - 1
    shared = int((other[places] == query).sum())
    return 100 * shared >= similarity * (n + m - shared)


def _can_share(similarity: int) -> Column:
    """Whether sets of n and m shingles, with a shared one at places i and j, can share T.

    Both are in one order, so if this is their first shared shingle no more than n - i and m - j
    can be shared. A pair that reaches T meets in the list of its first shared one.
    """
    enough = F.expr(f"ceil({similarity} * (n + m) / {100 + similarity})")
    near = 100 * F.least("n", "m") >= similarity * F.greatest("n", "m")
    return near & (F.col("n") - F.col("i") >= enough) & (F.col("m") - F.col("j") >= enough)


def _stars(lists: DataFrame, pick, similarity: int) -> DataFrame:
    """Pairs (a, b) of each list's members with one member of their size or of the next smaller."""
    member = F.struct("doc_id", "n_shingles", "place")
    hubs = lists.groupBy("shingle", "size_class").agg(
        pick(member).alias("hub"), F.count("*").alias("members")
    )
    # A single member has nobody to meet in its own class.
    own_class, next_class = F.col("size_class"), F.col("size_class") + 1
    met = F.when(F.col("members") > 1, F.array(own_class, next_class)).otherwise(F.array(next_class))
    hubs = hubs.select(
        "shingle", F.explode(met).alias("size_class"), F.col("hub.doc_id").alias("hub"),
        F.col("hub.n_shingles").alias("m"), F.col("hub.place").alias("j"),
    )
    return (
        lists.withColumnsRenamed({"n_shingles": "n", "place": "i"})
        .join(hubs, ["shingle", "size_class"])
        .filter("doc_id <> hub")
        .filter(_can_share(similarity))
        .select(F.greatest("doc_id", "hub").alias("a"), F.least("doc_id", "hub").alias("b"))
        .distinct()
    )


def _mixed(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Members of lists in which more than one component is left, with their component."""
    lists = lists.drop("component")
    placed = lists.join(found, lists["doc_id"] == found["node"], "left").select(
        "shingle", "doc_id", "n_shingles", "size_class", "place",
        F.coalesce("component", "doc_id").alias("component"),
    )
    open_lists = (
        placed.groupBy("shingle")
        .agg(F.min("component").alias("first"), F.max("component").alias("last"))
        .filter("first <> last")
        .select("shingle")
    )
    return placed.join(open_lists, "shingle")


def _rest(lists: DataFrame, similarity: int) -> DataFrame:
    """All pairs of different components that a short list brings together."""
    small = lists.select(
        "shingle", F.col("doc_id").alias("a"), F.col("n_shingles").alias("n"),
        F.col("component").alias("of_a"), F.col("size_class").alias("size_class"),
        F.col("place").alias("i"),
    )
    large = lists.select(
        "shingle", F.col("doc_id").alias("b"), F.col("n_shingles").alias("m"),
        F.col("component").alias("of_b"),
        F.explode(F.array("size_class", F.col("size_class") - 1)).alias("size_class"),
        F.col("place").alias("j"),
    )
    return (
        small.join(large, ["shingle", "size_class"])
        .filter("of_a <> of_b and (n < m or n = m and a < b)")
        .filter(_can_share(similarity))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def find_links(
    docs: DataFrame,
    stage: Stage,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    similarity: int = SIMILARITY,
) -> tuple[DataFrame, DataFrame]:
    """(doc_id and n_shingles, components of ``components``) for the links between documents."""
    plain = id_and_text(docs, id_col, text_col)
    listed = build_lists(plain, stage, width, similarity)
    lists = shared_lists(listed, stage, similarity)
    sizes = stage.table(listed.select("doc_id", "n_shingles"), "sizes", "zstd")
    stage.drop_table(listed)
    tried = found = None
    left, last = lists, False
    for pick in itertools.cycle((F.min, F.max)):
        pairs = _rest(left, similarity) if last else _stars(left, pick, similarity)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stage.table(pairs, "pairs", "zstd")
        links = probe(pairs, plain, stage, width, similarity)
        tried = pairs if tried is None else tried.union(pairs)
        joined = links.count() > 0
        if joined or found is None:
            # What is joined already stays joined by its stars; older links add nothing to them.
            known = links if found is None else links.union(found.toDF("a", "b"))
            found = components(known, stage)
        if last:
            return sizes, found
        # A list of one component stays one, so only the lists left need another look.
        before, left = left, stage.table(_mixed(left, found), "mixed", "zstd")
        stage.drop_table(before)
        n = left.groupBy("shingle").count().agg(F.sum("count"), F.sum(F.expr("count * count")))
        members, all_pairs = n.first()
        if not members:
            return sizes, found
        # Where stars join nothing any more, what is left are lists of unlike documents.
        last = not joined or all_pairs <= PAIRS_A_MEMBER * members


def near_duplicates(docs: DataFrame, stage: Stage, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    listed, found = find_links(docs, stage, **options)
    return listed.join(found, listed["doc_id"] == found["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, stage: Stage, id_col: str = "doc_id", **options) -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest id.

    Where ids repeat or are missing, rows are numbered first, in a written table, and the first row of
    each component stays; so no row is kept or lost for the id it shares.
    """
    if repeats_ids(docs, id_col):
        rows = stage.table(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows", "zstd")
    else:
        rows = docs.withColumn(ROW, docs[id_col].cast("bigint"))
    _, found = find_links(rows, stage, id_col=ROW, **options)
    dropped = stage.key_sets({"dropped": found.select(F.col("node").alias(NODE))})["dropped"]
    return rows.join(dropped, F.col(ROW) == F.col(NODE), "left_anti").select(*docs.columns)


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "documents"), Stage(spark))


ORACLE = {
    "op3_jaccard_join": r"""
WITH RECURSIVE texts AS (
    SELECT doc_id,
           list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(words[place:place + 3], ' ') AS shingle
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS place FROM texts WHERE len(words) > 0)
), sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b USING (shingle)
         JOIN sizes n ON n.doc_id = a.doc_id JOIN sizes m ON m.doc_id = b.doc_id
    WHERE a.doc_id <> b.doc_id AND 100 * least(n.n, m.n) >= 85 * greatest(n.n, m.n)
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 85 * (any_value(n.n) + any_value(m.n) - count(*))
), reached AS (
    SELECT doc_id AS node, doc_id AS goal FROM sizes
    UNION
    SELECT node, b FROM reached JOIN links ON goal = a
), least_of AS (
    SELECT node, min(goal) AS component_id FROM reached GROUP BY node
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON node = doc_id
"""
}
