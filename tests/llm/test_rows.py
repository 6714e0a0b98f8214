"""Rows with null and repeated ids, repeated rows and columns with clashing names, in all operators."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    importance,
    jaccard_join,
    language_id,
    line_dedup,
    lm_score,
    period_runs,
    simhash_groups,
    substring_dedup,
    suffix_dedup,
    toxicity,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, node long, component long, hash string, "
    "bucket int, bad_id long, refused_id long, kept_id long, shingle long, plain string, rank int, "
    "bytes string, key long, vote string, host string, label string, item_id string, slot int"
)
rng = random.Random(8)
WORDS = [a + b for a in "ba do mi la tu".split() for b in "ran sel pik tor vo".split()]
LONG = [" ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(80)) for _ in range(12)]


def rows():
    """(doc_id, text): null ids, ids of several texts, rows given twice, near and exact copies."""
    near = LONG[0].split()
    near[40] = "changed"
    out = [(1, LONG[0]), (1, LONG[1]), (None, LONG[2]), (None, LONG[3]), (None, LONG[2]), (2, LONG[0] + " ")]
    out += [(3, " ".join(near)), (None, " ".join(near)), (4, None), (4, ""), (None, None), (5, LONG[4]), (5, LONG[4])]
    return out + [(10 + i, text) for i, text in enumerate(LONG[5:])] + [(6, "!!"), (7, LONG[6] + "\n" + LONG[6])]


def table(spark, given):
    rest = (1, 2, 3, "h", 4, 5, 6, 7, 8, "p", 9, "b", 10, "v", "h", "l", "i", 11)
    return spark.createDataFrame([(i, t, "en", "s", *rest) for i, t in given], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, rows())


def counted(df, *names):
    return collections.Counter(tuple(row) for row in df.select(*names).collect())


def plain(text):
    return "".join((text or "").split())


@pytest.mark.parametrize("hot_rows", [1, 1000])
@pytest.mark.parametrize("capacity", [1, 2000])
def test_exact_copies_of_rows(docs, stage, capacity, hot_rows):
    groups = collections.defaultdict(list)
    for i, t in rows():
        groups[plain(t)].append((-len(t or ""), i is None, i))
    got = exact_dedup.find_copies(docs, stage, capacity=capacity, hot_rows=hot_rows)
    expected = collections.Counter()
    for members in groups.values():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        for n, m in enumerate(sorted(members, key=lambda m: (m[0], m[1], m[2] or 0))):
            expected[m[2], best[2], len(members), n == 0] += 1
    assert counted(got, "doc_id", "keep_id", "group_size", "kept") == expected
    kept = exact_dedup.keep_first_copies(docs, stage, capacity=capacity, hot_rows=hot_rows)
    assert kept.columns == docs.columns
    assert collections.Counter(plain(r.text) for r in kept.collect()) == collections.Counter(list(groups))


def test_the_index_is_in_its_files(spark, stage):
    texts = [f"text {i % 700}" for i in range(3000)] + ["hot"] * 900
    df = table(spark, enumerate(texts))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, False)
    index = exact_dedup.build_index(df, stage, capacity=20, hot_rows=100)
    spark.conf.unset(coalesce)
    from_files = spark.read.parquet(stage._paths[id(index)][1])
    held = from_files.filter("bytes is not null and nth = 1")
    assert counted(held, "bytes") == collections.Counter((plain(t),) for t in set(texts))
    # A bucket is a range of keys, of twenty texts at most, all in one file but for hot ones.
    sizes = held.groupBy("bucket").count().collect()
    assert len(sizes) > 35 and max(r["count"] for r in sizes) <= 20
    located = from_files.select("bucket", "group_size", F.col("_metadata.file_name").alias("file"))
    cold = located.filter("group_size < 100").groupBy("bucket").agg(F.count_distinct("file").alias("n"))
    assert {r.n for r in cold.collect()} == {1}
    spread = located.filter("group_size = 900").select("file").distinct().count()
    ranges = held.groupBy("bucket").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).collect()
    unsigned = sorted((r.a % 2**64, r.b % 2**64) for r in ranges if (r.a < 0) == (r.b < 0))
    assert spread > 1 and all(b < c for (_, b), (c, _) in zip(unsigned, unsigned[1:]))
    assert "python" not in index._jdf.queryExecution().toString().lower()


def test_one_row_of_each_component(docs, stage):
    kept = jaccard_join.keep_one_of_each(docs, stage, width=5, similarity=80)
    assert kept.columns == docs.columns
    texts = collections.Counter(r.text for r in kept.collect())
    # Texts without words are linked with nothing, so all of their rows stay.
    assert texts[None] == 2 and texts[""] == 1
    # "!!" is a word of its own; of LONG[0] and its near copies one stays, and one of each other text.
    assert sum(texts.values()) == 3 + 1 + len(LONG)
    assert texts[LONG[1]] == texts[LONG[2]] == texts[LONG[3]] == texts[LONG[4]] == 1


def test_rows_are_identified_one_by_one(spark, docs, stage):
    kept = language_id.keep_identified(docs, stage)
    assert kept.columns == docs.columns
    expected = collections.Counter((i, t) for i, t in rows() if any(c.isalpha() for c in t or ""))
    assert counted(kept, "doc_id", "text") == expected


@pytest.mark.parametrize("block_bytes", [100, 1 << 20])
def test_rows_are_decontaminated_one_by_one(spark, docs, stage, block_bytes):
    items = spark.createDataFrame(
        [(None, " ".join(LONG[1].split()[:30])), (7, " ".join(LONG[2].split()[9:40])), (8, None), (9, "nothing of this")],
        "item_id long, text string",
    )
    hits = decontaminate.judged(decontaminate.find_hits(docs, items, stage, block_bytes=block_bytes))
    found = counted(hits, "doc_id", "n_hit", "n_items")
    assert sum(found.values()) == len(rows())
    assert found[1, 30, 0] == 1 and found[None, 31, 1] == 2
    clean = decontaminate.keep_clean(docs, items, stage)
    expected = collections.Counter((i, t) for i, t in rows() if t not in (LONG[1], LONG[2]))
    assert counted(clean, "doc_id", "text") == expected


def test_no_operator_stumbles_over_rows_or_names(spark, docs, stage):
    n = len(rows())
    assert bpe.round_trip(docs, bpe.vocabulary_path()).count() == n
    assert jaccard_join.near_duplicates(docs, stage).count() == n
    assert substring_dedup.remove_repeats(docs, stage).count() == n
    assert suffix_dedup.remove_repeats(docs, stage).count() == n
    assert line_dedup.remove_lines(docs, stage).count() == n
    assert lm_score.score_documents(docs, stage).count() == n
    assert period_runs.digests(period_runs.find_runs(period_runs.with_periods(docs))).count() == n
    assert importance.resample(docs, docs, stage).count() == n
    assert simhash_groups.near_duplicates(docs, stage).count() == n
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (None, 1, 1), (5, None, 0)], "doc_id long, low_quality int, toxic int")
    chain = toxicity.train(docs.select("doc_id", "text"), labels, stage, ("low_quality", "toxic"))
    assert toxicity.score(docs, chain).count() == n


def test_conflicting_labels(spark, docs, stage):
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (5, 0, 0), (5, 0, 0), (6, 3, 0)], "doc_id long, a int, b int")
    plain_docs = docs.select("doc_id", "text")
    got = toxicity.training_rows(plain_docs, labels, ("a", "b"), 1000)
    assert {(r.doc_id, r.a, r.b) for r in got.collect()} == {(1, 1, 1), (5, 0, 0), (6, 1, 0)}


def test_a_language_of_few_rows_stays_one(spark, stage):
    english = ["the house by the river was old and the door was open", "she went to the market and bought bread and milk"]
    french = ["la maison au bord de la rivière était vieille et la porte ouverte", "elle est allée au marché pour acheter du pain"]
    given = [(i, english[i % 2] + f" {'and' * (i % 3)} then", "en") for i in range(60)]
    given += [(100 + i, french[i % 2] + f" {'puis' * (i % 3)}", "fr") for i in range(4)] + [(200, "xq zzkw vvqx " * 6, "de")]
    df = spark.createDataFrame([(*g, "s") for g in given], "doc_id long, text string, lang string, source string")
    judged = language_id.identify(language_id.of_documents(df), language_id.labels_of(df), stage)
    found = {r.doc_id: (r.language, r.accepted) for r in judged.collect()}
    assert all(found[i] == (lang, True) for i, _, lang in given if i < 200)
    # Declared in a language without a table, and like none of those known.
    others = df.filter("doc_id < 200")
    strange = spark.createDataFrame([(300, "xq zzkw vvqx wkjq " * 9, "xx", "s")], df.schema)
    judged = language_id.identify(language_id.of_documents(strange), language_id.labels_of(others), stage)
    assert not judged.first().accepted


def test_every_stage_of_the_pipeline_on_such_rows(spark, docs, tmp_path):
    import corpus_pipeline

    folder = tmp_path / "sf"
    items = spark.createDataFrame([(None, " ".join(LONG[1].split()[:30]))], "item_id string, text string")
    items.write.parquet(str(folder / "benchmark.parquet"))
    for name, given in (("full", docs), ("empty", docs.limit(0))):
        left = given
        for number, (_, step) in enumerate(corpus_pipeline.STAGES):
            out = str(tmp_path / f"{name}{number}")
            step(spark, left, str(folder)).write.parquet(out)
            left = spark.read.parquet(out)
            assert number == 4 or left.columns == docs.columns
        # LONG[0], its near copies and copies are one, LONG[1] is contaminated.
        assert left.count() == (len(LONG) - 1 if name == "full" else 0)


def test_a_very_long_text(spark, stage):
    words = np.random.default_rng(3).integers(0, 50_000, 400_000)
    text = " ".join(f"w{x}" for x in words.tolist())
    df = spark.createDataFrame([(1, text), (2, text + " end"), (3, "short one")], "doc_id long, text string")
    assert len(text) > 2_000_000
    found = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(df, stage).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    runs = period_runs.find_runs(df).collect()
    assert {r.doc_id: (r.n_words, len(r.runs)) for r in runs} == {1: (400_000, 0), 2: (400_001, 0), 3: (2, 0)}
    assert {r.doc_id: r.group_size for r in exact_dedup.find_copies(df, stage).collect()} == {1: 1, 2: 1, 3: 1}
    groups = {r.doc_id: r.component_id for r in simhash_groups.near_duplicates(df, stage).collect()}
    assert groups == {1: 1, 2: 1, 3: 3}
    gone = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(df, stage).collect()}
    assert gone == {1: 0, 2: 400_000, 3: 0}
