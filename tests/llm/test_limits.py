"""What operators may move and hold, on small tables with the limits turned down."""

from __future__ import annotations

import collections
import random
import tracemalloc
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from siftwork.llm import bpe, jaccard_join, line_dedup, lm_score
from siftwork.plans.stage import Stage


@pytest.fixture()
def plans(monkeypatch):
    """The plan of each staged table, by its name, as it was before the write."""
    seen: dict[str, list[str]] = collections.defaultdict(list)
    plain = Stage.table

    def table(self, df, name, *args, **options):
        seen[name].append(df._jdf.queryExecution().executedPlan().toString())
        return plain(self, df, name, *args, **options)

    monkeypatch.setattr(Stage, "table", table)
    return seen


def test_texts_are_not_sent_to_find_those_in_pairs(spark, stage, plans):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(900)}"
    base = [word() for _ in range(200)]
    texts = [" ".join(base[:k] + [f"edit{k}"] + base[k + 1 :]) for k in range(0, 200, 25)]
    texts += [" ".join(word() for _ in range(60)) for _ in range(80)]
    rows = list(enumerate(texts)) + [(None, texts[0]), (500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = jaccard_join.near_duplicates(docs, stage).collect()
        assert plans["texts"] and not any("Exchange" in plan for plan in plans["texts"])
        # Only the documents of the pairs are packed.
        assert {r.component_id for r in got if r.doc_id is not None and r.doc_id < 8} == {0}
        assert all(r.component_id == r.doc_id for r in got if r.doc_id is not None and r.doc_id >= 8)
        assert len(got) == len(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("similarity", [85, 80])
def test_lists_hold_only_members_that_can_meet(spark, stage, similarity):
    """However many lists there are, none of a single document is built, and none of sizes far apart."""
    rng = random.Random(similarity)
    rows = [
        (i, rng.choice([1, 2, 7, 8, 9, 10, 12, 15, 40, 46, 47, 300, 90_000]), rng.sample(range(400), rng.randint(0, 9)))
        for i in range(160)
    ]
    listed = spark.createDataFrame(rows, "doc_id long, n_shingles long, shingles array<long>")
    got = jaccard_join.shared_lists(listed, stage, similarity)
    own = {(r.shingle, r.doc_id, r.n_shingles, r.place): r.size_class for r in got.collect()}
    members = collections.defaultdict(list)
    for i, n, shingles in rows:
        for place, shingle in enumerate(shingles):
            members[shingle].append((i, n, place))
    size_class = lambda n: int(np.floor(np.log(n) / np.log(100 / similarity)))
    for shingle, inside in members.items():
        classes = [size_class(n) for _, n, _ in inside]
        crowded = len(classes) > len(set(classes))
        for (i, n, place), c in zip(inside, classes):
            met = crowded or c + 1 in classes or c - 1 in classes
            assert ((shingle, i, n, place) in own) == met
            for j, m, _ in inside:
                if i != j and 100 * min(n, m) >= similarity * max(n, m):
                    assert (shingle, i, n, place) in own
    assert all(c == size_class(n) for (_, _, n, _), c in own.items())
    assert got.groupBy("shingle").agg(F.count("*").alias("n")).filter("n < 2").isEmpty()


def test_small_packs_score_as_one_does(spark, stage, monkeypatch):
    rng = random.Random(4)
    words = [f"w{int(1.5 ** rng.uniform(0, 16))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(150)] + [(999, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    monkeypatch.setattr(lm_score, "HEAVY", 100)
    monkeypatch.setattr(lm_score, "PARTS", 3)
    whole = {r.doc_id: r for r in lm_score.score_documents(docs, stage).collect()}
    monkeypatch.setattr(lm_score, "PACK", 400)
    in_packs = {r.doc_id: r for r in lm_score.score_documents(docs, stage).collect()}
    assert whole.keys() == in_packs.keys() == {i for i, _ in rows}
    for i, r in whole.items():
        assert r.n_pairs == in_packs[i].n_pairs
        assert r.log10_score == pytest.approx(in_packs[i].log10_score, rel=1e-12)


def test_open_pairs_never_become_python_objects(spark):
    """Scoring a part takes a few arrays: objects for each open pair would take some hundred bytes more."""
    sent = []
    packed = types.SimpleNamespace(sparkSession=spark)
    packed.groupBy = lambda name: types.SimpleNamespace(applyInArrow=lambda f, ddl: sent.append(f))
    lm_score.score_parts(packed, lm_score.Counts([5], [1000]), 1000)
    n = 200_000
    # Each pair occurs in two documents, so all are open, as no context is known.
    keys = ((np.arange(n, dtype=np.uint64) // np.uint64(2)) << np.uint64(32)) | np.uint64(9)
    columns = [[0], [False], [np.arange(n) % 1000], [np.ones(n, np.int32)], [keys.tobytes()], [bytes(2 * n)]]
    table = pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, lm_score.PACKED)], schema=lm_score.PACKED)
    tracemalloc.start()
    out = sent[0](table)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert out.num_rows == 1000 and pc.sum(pc.list_value_length(out["rare"])).as_py() == n
    assert out["rare"][0].as_py()[0] == {"context": 9, "n": 1, "tf": 1}
    assert peak < 200 * n


def test_workers_forget_the_pieces_of_a_bpe_task(spark):
    """Workers are kept for tasks of other stages, which need the memory."""
    path = bpe.vocabulary_path()
    rows = [(i, " ".join(f"piece{i}x{k}" for k in range(50))) for i in range(200)] + [(None, "a b c"), (900, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)

    def held(batches):
        for _ in batches:
            pass
        found = list(bpe._tokenizers.values())
        n = sum(len(t.remembered) + len(t.remembered.older) for t in found)
        yield pa.RecordBatch.from_pydict({"tokenizers": [len(found)], "pieces": [n]})

    tokens = bpe.encode_column(docs, path)
    for task in (bpe.round_trip(docs, path), tokens, bpe.decode_column(tokens, path)):
        assert task.count() == len(rows)
        task.write.format("noop").mode("overwrite").save()
        left = spark.range(0, 32, 1, 32).mapInArrow(held, "tokenizers long, pieces long").collect()
        # A worker that ran a task is among them, and keeps its vocabulary.
        assert any(r.tokenizers for r in left) and not any(r.pieces for r in left)
    texts = {r.doc_id: r.text for r in bpe.decode_column(tokens, path).collect()}
    assert texts == {i: text or "" for i, text in rows}


def test_a_full_bitmap_makes_no_more_variants_of_lines(spark, monkeypatch):
    """Only lines that share a part with another one are ranked and spelt out."""
    rng = random.Random(8)
    line = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    rows = [(i, "\n".join([line(60), "common line", line(45)])) for i in range(150)]
    # Lines one edit away, lines that only share a part, ids that repeat, and none.
    near = [t.split("\n")[0] for _, t in rows[:20]]
    rows += [(500 + i, t[:i] + "Q" + t[i + (i % 2) :]) for i, t in enumerate(near)]
    rows += [(600 + i, t[:45] + line(15)) for i, t in enumerate(near)]
    rows += [(3, near[4][:-1] + "Z"), (None, near[5] + "Z"), (None, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain, counts = Stage.table, collections.Counter()

    def table(self, df, name, *args, **options):
        out = plain(self, df, name, *args, **options)
        counts[name] += out.count()
        return out

    monkeypatch.setattr(Stage, "table", table)
    found = []
    for bits in (26, 6):
        monkeypatch.setattr(line_dedup, "BITS", bits)
        counts.clear()
        kept = line_dedup.remove_lines(docs, Stage(spark)).collect()
        # Whichever of the two is written: the lines that are spelt out, or their variants.
        found.append((sorted(map(str, kept)), counts["ranked"] + counts["variants"], counts["pairs"]))
    assert found[0] == found[1]
    assert 40 <= found[0][1] <= 80
    # The null id comes first, so the line near[5] of document 5 goes; document 0 is the first of "common line".
    gone = sum(r.n_removed for r in kept)
    assert gone == 149 + 20 + 1 + 1
