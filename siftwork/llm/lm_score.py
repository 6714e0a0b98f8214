"""Language-model scores of documents by stupid backoff over word pairs, computed relationally.

A document is its words between a start and an end mark. A pair (h, w) that occurs tf times in a
document and c(hw) times in the corpus scores, for each of its occurrences,

    (c(hw) - tf) / (c(h) - tf)            if c(hw) > tf, that is, if it also occurs elsewhere,
    0.4 * max(c(w) - tf, 0.5) / N         otherwise,

so no document vouches for itself. The result has the sum of the decimal logarithms.

Counting and scoring meet in one shuffle. Each task explodes its documents into pairs and deals
these by the hash of w, so that a part has all occurrences of its words and their pairs: it
counts both, joins the counts to the occurrences and sums by document. Pairs travel in packed
arrays. Words that make up more than one in ``HEAVY`` of the corpus, of which there can be no more
than that many, are counted first and known to all tasks, and their pairs are dealt by both words.
Pairs that hold a large share of the corpus themselves are found and counted likewise (there are
fewer than 2 * ``PAIRS``) and scored where they are, so no part depends on one word or pair. What a
part lacks is c(h) of rare contexts; those occurrences join the table of word counts.

Word identities are 47 bits of a hash, rare predicted words 32 bits and the bits of their part.
Null and empty texts have one pair, of the two marks. Repeated rows count each; rows of one id are
scored together as one document. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm.common import (
    batches_of,
    give_back,
    id_and_text,
    mixed,
    read,
    records,
    repeats_ids,
    word_hashes,
)
from siftwork.plans.stage import Stage

BACKOFF, UNSEEN = 0.4, 0.5
#: A word is heavy if it makes up at least one in so many occurrences.
HEAVY = 1 << 17
#: A pair is heavy if it makes up about one in so many occurrences.
PAIRS = 1 << 11
#: Occurrences that a part is meant to hold, and parts at least.
PART, PARTS = 2_000_000, 64
#: Occurrences that a task counts at once, and that it packs at once, which takes more memory.
CHUNK, PACK = 2_000_000, 500_000

START, END = np.uint64(1), np.uint64(2)
_ID = np.uint64((1 << 47) - 1)
_LOW32 = np.uint64((1 << 32) - 1)


def word_ids(text: bytes) -> np.ndarray:
    """Identities of the words of a text, between the two marks."""
    words = word_hashes(text) & _ID
    return np.concatenate(([START], words, [END]))


def pair_keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(h * np.uint64(0xA0761D6478BD642F) ^ mixed(w))


def chunks(batches, size: int = CHUNK):
    """(document ids, pairs of each, contexts, words) of a few million occurrences at a time."""
    ids, sizes, held, n = [], [], [], 0
    for doc_id, text in records(batches):
        own = word_ids(text)
        ids.append(doc_id)
        sizes.append(len(own) - 1)
        held.append(own)
        n += len(own)
        if n >= size:
            yield _joined(ids, sizes, held)
            ids, sizes, held, n = [], [], [], 0
    if ids:
        yield _joined(ids, sizes, held)


def _joined(ids, sizes, held):
    h = np.concatenate([x[:-1] for x in held])
    w = np.concatenate([x[1:] for x in held])
    return ids, np.array(sizes), h, w


class Counts:
    """Known counts by sorted identity."""

    def __init__(self, keys, counts):
        keys = np.asarray(keys, dtype=np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], np.asarray(counts, dtype=np.int64)[order]

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether known, place) of each key."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
        places = np.searchsorted(self.keys, keys)
        places[places == len(self.keys)] = 0
        return self.keys[places] == keys, places


def count_words(docs: DataFrame, stage: Stage) -> DataFrame:
    """Table of kind, key, n: words (0) with their counts, likely heavy pairs (1) with lower bounds.

    A chunk leaves out pairs that make up less than one in PAIRS of it. Together that is less than
    one in PAIRS of the corpus, so a pair above twice that keeps at least half its count.
    """
    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64())])

    def count(batches):
        for _, _, h, w in chunks(batches):
            # The start mark counts as a context, all others as words.
            words, n = np.unique(np.concatenate((w, h[h == START])), return_counts=True)
            pairs, m = np.unique(pair_keys(h, w), return_counts=True)
            large = m * PAIRS >= len(w)
            pairs, m = pairs[large], m[large]
            kind = np.repeat(np.array([0, 1], dtype=np.int32), [len(words), len(pairs)])
            keys = np.concatenate((words, pairs)).view(np.int64)
            columns = [pa.array(kind), pa.array(keys), pa.array(np.concatenate((n, m)))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        give_back()

    counted = docs.mapInArrow(count, "kind int, key bigint, n bigint")
    return stage.table(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "words", "zstd")


def _collected(table: DataFrame) -> Counts:
    found = table.select("key", "n").toArrow()
    return Counts(found["key"].to_numpy(), found["n"].to_numpy())


def count_pairs(docs: DataFrame, wanted: np.ndarray) -> Counts:
    """Exact counts of a bounded set of pairs."""
    if not len(wanted):
        return Counts([], [])
    known = docs.sparkSession.sparkContext.broadcast(Counts(wanted.view(np.int64), np.zeros(len(wanted))))
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def count(batches):
        total = np.zeros(len(known.value.keys), dtype=np.int64)
        for _, _, h, w in chunks(batches, PACK):
            inside, places = known.value.places(pair_keys(h, w))
            total += np.bincount(places[inside], minlength=len(total))
        keys = known.value.keys.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total)], schema=schema)
        give_back()

    return _collected(docs.mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")))


def _own_counts(owner: np.ndarray, keys: np.ndarray):
    """Distinct (key, owner) in order, their numbers, and for each the number of its key."""
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    new_key = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
    new = new_key | np.concatenate(([True], owner[1:] != owner[:-1])) if len(keys) else new_key
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(keys)))
    group = np.cumsum(new_key[at]) - 1
    total = np.bincount(group, weights=tf).astype(np.int64) if len(at) else np.zeros(0, np.int64)
    return order[at], keys[at], owner[at], tf, total[group] if len(at) else total


PACKED = pa.schema(
    [
        ("part", pa.int64()),
        ("spread", pa.bool_()),
        ("ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int32())),
        ("keys", pa.binary()),
        ("more", pa.binary()),
    ]
)
PACKED_DDL = (
    "part bigint, spread boolean, ids array<bigint>, sizes array<int>, keys binary, more binary"
)


def deal_pairs(docs: DataFrame, words: Counts, pairs: Counts, n_words: int, parts: int) -> DataFrame:
    """Packed occurrences by part; of heavy pairs, the sums of each document (spread is null)."""
    known = docs.sparkSession.sparkContext.broadcast((words, pairs))

    def deal(batches):
        words, pairs = known.value
        for ids, sizes, h, w in chunks(batches, PACK):
            ids = np.array(ids, dtype=np.int64)
            owner = np.repeat(np.arange(len(ids)), sizes)
            key = pair_keys(h, w)
            large, place = pairs.places(key)
            yield from _scored_here(ids, owner[large], h[large], w[large], place[large], words, pairs)
            owner, h, w, key = owner[~large], h[~large], w[~large], key[~large]
            heavy, place = words.places(w)
            spread_part = (key >> np.uint64(20)) % np.uint64(parts)
            own_part = mixed(w) % np.uint64(parts)
            packed = (place[heavy].astype(np.uint64) << np.uint64(47)) | h[heavy]
            yield from _packed(ids, owner[heavy], spread_part[heavy], packed, None)
            light = ~heavy
            packed = ((w[light] & _LOW32) << np.uint64(32)) | (h[light] & _LOW32)
            more = (h[light] >> np.uint64(32)).astype(np.uint16)
            yield from _packed(ids, owner[light], own_part[light], packed, more)
        give_back()

    def _packed(ids, owner, part, keys, more):
        order = np.argsort(part, kind="stable")
        owner, part, keys = owner[order], part[order], keys[order]
        more = more[order] if more is not None else None
        cuts = np.flatnonzero(np.diff(part.astype(np.int64))) + 1
        rows = []
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(part))):
            if a == b:
                continue
            own = owner[a:b]
            at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            sizes = np.diff(np.append(at, b - a)).astype(np.int32)
            rest = more[a:b].tobytes() if more is not None else None
            rows.append((int(part[a]), more is None, ids[own[at]], sizes, keys[a:b].tobytes(), rest))
        yield from batches_of(rows, PACKED, 32)

    def _scored_here(ids, owner, h, w, place, words, pairs):
        _, key, own, tf, _ = _own_counts(owner, place.astype(np.uint64))
        count = pairs.counts[key.astype(np.int64)]
        context = np.zeros(len(pairs.keys), dtype=np.uint64)
        word = np.zeros(len(pairs.keys), dtype=np.uint64)
        context[place], word[place] = h, w
        # A heavy pair's words are heavy.
        of_h = words.counts[words.places(context[key.astype(np.int64)])[1]]
        of_w = words.counts[words.places(word[key.astype(np.int64)])[1]]
        score = np.where(
            count > tf,
            np.log10(np.maximum(count - tf, 1) / np.maximum(of_h - tf, 1)),
            np.log10(BACKOFF * np.maximum(of_w - tf, UNSEEN) / n_words),
        )
        sums = np.bincount(own, weights=score * tf, minlength=len(ids))
        n = np.bincount(own, weights=tf, minlength=len(ids)).astype(np.int32)
        # Sums travel by document number, so that no part gets those of many tasks.
        part = np.arange(len(ids)) % parts
        rows = []
        for p in range(min(parts, len(ids))):
            mine = part == p
            rows.append((p, None, ids[mine], n[mine], sums[mine].tobytes(), None))
        yield from batches_of(rows, PACKED, 32)

    return docs.mapInArrow(deal, PACKED_DDL)


def score_parts(packed: DataFrame, words: Counts, n_words: int) -> DataFrame:
    """doc_id, score, and (context, left, tf) where the context's count is not known here."""
    known = packed.sparkSession.sparkContext.broadcast(words)
    rare = pa.struct([("context", pa.int64()), ("n", pa.int64()), ("tf", pa.int64())])
    schema = pa.schema(
        [("doc_id", pa.int64()), ("score", pa.float64()), ("n_pairs", pa.int64()), ("rare", pa.list_(rare))]
    )

    def run(table: pa.Table) -> pa.Table:
        words, spread = known.value, table["spread"]
        out = [schema.empty_table()]
        chosen = table.filter(pc.is_null(spread))
        ids = _flat(chosen["ids"])
        none = pa.nulls(len(ids), schema.field("rare").type)
        out.append(_scored(ids, _bytes(chosen["keys"], np.float64), _flat(chosen["sizes"]), none))
        for kind in (True, False):
            chosen = table.filter(pc.equal(spread, kind))
            if not chosen.num_rows:
                continue
            keys = _bytes(chosen["keys"], np.uint64)
            # No id is missing here, and they come out in order, whatever order they came in.
            ids, which = np.unique(_flat(chosen["ids"]), return_inverse=True)
            owner = np.repeat(which, _flat(chosen["sizes"]))
            if kind:
                _, key, own, tf, count = _own_counts(owner, keys)
                h, of_w = key & _ID, words.counts[(key >> np.uint64(47)).astype(np.int64)]
            else:
                more = _bytes(chosen["more"], np.uint16)
                h = (more.astype(np.uint64) << np.uint64(32)) | (keys & _LOW32)
                w = keys >> np.uint64(32)
                del more, keys
                at, _, own, tf, count = _own_counts(owner, pair_keys(h, w))
                _, place, n = np.unique(w, return_inverse=True, return_counts=True)
                h, of_w = h[at], n[place[at]]
                del w, place
            seen = count > tf
            heavy, place = words.places(h)
            of_h = words.counts[place] if len(words.counts) else np.ones(len(h), dtype=np.int64)
            score = np.where(
                seen & heavy,
                np.log10(np.maximum(count - tf, 1) / np.maximum(of_h - tf, 1)),
                np.where(seen, 0.0, np.log10(BACKOFF * np.maximum(of_w - tf, UNSEEN) / n_words)),
            )
            sums = np.bincount(own, weights=score * tf, minlength=len(ids))
            n = np.bincount(own, weights=tf, minlength=len(ids)).astype(np.int64)
            found = np.flatnonzero(seen & ~heavy)
            found = found[np.argsort(own[found], kind="stable")]
            held = np.bincount(own[found], minlength=len(ids))
            ends = np.append(0, np.cumsum(held)).astype(np.int32)
            values = [h[found].view(np.int64), (count - tf)[found], tf[found]]
            values = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in values], fields=list(rare))
            lists = pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array(held == 0))
            out.append(_scored(ids, sums, n, lists.cast(schema.field("rare").type)))
        return pa.concat_tables(out)

    def _scored(ids, sums, n, lists) -> pa.Table:
        columns = [pa.array(ids, pa.int64()), pa.array(sums, pa.float64()), pa.array(n, pa.int64()), lists]
        return pa.Table.from_arrays(columns, schema=schema)

    def part(table: pa.Table) -> pa.Table:
        scored = run(table)
        # What the part took is free again, and the next part or another stage's tasks may need it.
        give_back()
        return scored

    ddl = "doc_id bigint, score double, n_pairs bigint, rare array<struct<context: bigint, n: bigint, tf: bigint>>"
    return packed.groupBy("part").applyInArrow(part, ddl)


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(lists).to_numpy()


def _bytes(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """The values of all packed arrays of a column, one after the other."""
    return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(x.as_buffer(), dtype) for x in column)])


def score_documents(
    docs: DataFrame, stage: Stage, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_pairs, log10_score (the sum), log10_per_pair."""
    plain = id_and_text(docs, id_col, text_col)
    names = None
    if repeats_ids(plain):
        # Rows are numbered in a written table, so that rows of one id are scored one by one.
        rows = stage.table(plain.withColumn("row", F.monotonically_increasing_id()), "rows", "zstd")
        names = rows.select(F.col("row").alias("of_row"), F.col("doc_id").alias("of_id"))
        plain = rows.select(F.col("row").alias("doc_id"), "text")
    counted = count_words(plain, stage)
    all_words = counted.filter("kind = 0").select("key", "n")
    n_words = all_words.filter(F.col("key") != int(START)).agg(F.sum("n")).first()[0] or 1
    words = _collected(all_words.filter(F.col("n") * HEAVY >= int(n_words)))
    likely = counted.filter("kind = 1").filter(F.col("n") * 2 * PAIRS >= int(n_words))
    likely = likely.select("key").toArrow()["key"].to_numpy().view(np.uint64)
    pairs = count_pairs(plain, likely)
    parts = max(PARTS, -(-int(n_words) // PART))
    packed = deal_pairs(plain, words, pairs, int(n_words), parts)
    scored = stage.table(score_parts(packed, words, int(n_words)), "scored", "zstd")
    rare = (
        scored.filter("rare is not null")
        .select("doc_id", F.explode("rare").alias("x"))
        .join(all_words, F.col("x.context") == F.col("key"))
        .select(
            "doc_id",
            (F.col("x.tf") * F.log10(F.col("x.n") / (F.col("n") - F.col("x.tf")))).alias("score"),
            F.lit(0).cast("bigint").alias("n_pairs"),
        )
    )
    summed = (
        scored.select("doc_id", "score", "n_pairs")
        .union(rare)
        .groupBy("doc_id")
        .agg(F.sum("score").alias("log10_score"), F.sum("n_pairs").alias("n_pairs"))
    )
    if names is not None:
        summed = summed.join(names, F.col("doc_id") == F.col("of_row")).withColumn("doc_id", F.col("of_id"))
    per_pair = F.col("log10_score") / F.col("n_pairs")
    return summed.select("doc_id", "n_pairs", "log10_score", per_pair.alias("log10_per_pair"))


def op10_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(read(spark, folder, "documents"), Stage(spark))
