"""The operators for training data against brute force, on small tables with hard cases."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest

from siftwork.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    jaccard_join,
    language_id,
    line_dedup,
    lm_score,
    queries,
    substring_dedup,
    suffix_dedup,
    toxicity,
)
from siftwork.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, hash string, spans int, n int"


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def hard_texts() -> list[tuple[int, str | None]]:
    """Nulls, empty, blank and long texts, copies, near copies and shared passages."""
    rng = random.Random(5)
    words = [a + b for a in "ba do mi la tu né".split() for b in "ran sel pik tor vo".split()]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    base, passage = text(120), text(60)
    out: list[str | None] = [None, "", " \t\n", "one", base, base, base + " ", base.replace(" ", "  ", 2)]
    for k in range(6):
        own = base.split()
        own[7 * k + 3] = f"edit{k}"
        out.append(" ".join(own))
    out += [text(20) + " " + passage + " " + text(30 + k) for k in range(5)]
    out += ["aaaa " * 300, "a" * 900, "ab" * 700, text(3000), "ABC  Def ghi", "abc def GHI", "x\n\nx\nX"]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", "h", 1, None) for i, t in hard_texts()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def no_items(spark):
    return spark.createDataFrame([], "item_id long, text string")


def by_id(df):
    return {row[0]: tuple(row)[1:] for row in df.collect()}


def test_exact_copies(docs, stage):
    got = by_id(exact_dedup.find_copies(docs, stage, capacity=4))
    groups = collections.defaultdict(list)
    plain = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in hard_texts()}
    texts = dict(hard_texts())
    for i, p in plain.items():
        groups[p].append(i)
    for i, p in plain.items():
        keep = min(groups[p], key=lambda k: (-len(texts[k] or ""), k))
        assert got[i][:4] == (keep, len(groups[p]), keep == i, sha(p))


def test_tokens_agree_with_the_library(docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.vocabulary_path()
    library = tokenizers.Tokenizer.from_file(path)
    got = by_id(bpe.round_trip(docs, path))
    for i, t in hard_texts():
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), sha(",".join(map(str, ids))), sha(decoded))
    columns = by_id(bpe.decode_column(bpe.encode_column(docs, path), path))
    assert all(columns[i] == (t or "",) for i, t in hard_texts())


@pytest.mark.parametrize("size", [1, 3, 50, 5000])
def test_encoder_does_not_depend_on_chunks(size):
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.vocabulary_path()
    library, own = tokenizers.Tokenizer.from_file(path), bpe.tokenizer_of(path)
    rng = random.Random(size)
    parts = ["a", "the", " ", "\n", "'re", "'", "é", "日本", "12", "<|endoftext|>", "<|endof", "!!"]
    texts = ["".join(rng.choices(parts, k=40)) for _ in range(60)] if size < 100 else []
    texts += ["x" * 9000 + "y z", "=-" * 4000, " " * 6000 + "a", "\n" * 5000]
    for text in texts if size > 1 else texts[:60]:
        encoder, out = own.encoder(), []
        for at in range(0, len(text), size):
            out += encoder.feed(text[at : at + size])
        assert out + encoder.finish() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("width, similarity", [(4, 85), (5, 80)])
def test_jaccard_components(docs, stage, width, similarity):
    got = by_id(jaccard_join.near_duplicates(docs, stage, width=width, similarity=similarity))
    sets, parent = {}, {}
    for i, t in hard_texts():
        w = (t or "").encode().lower().split()
        shingles = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))}
        sets[i], parent[i] = (shingles if w else set()), i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert got == {i: (len(s), root(i)) for i, s in sets.items()}


def test_substrings(docs, stage):
    got = by_id(substring_dedup.remove_repeats(docs, stage))
    words, first = {i: (t or "").encode().split() for i, t in hard_texts()}, {}
    for i, w in words.items():
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        assert got[i] == (len(w), len(gone), kept)


def test_byte_strings(docs, stage, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARE", 100)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 500)
    got = by_id(suffix_dedup.remove_repeats(docs, stage))
    data = {i: (t or "").encode() for i, t in hard_texts()}
    count = collections.Counter(b[k : k + 200] for b in data.values() for k in range(len(b) - 199))
    for i, b in data.items():
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        spans = int(np.diff(np.concatenate(([0], gone, [0]))).clip(0).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        n, removed, n_spans, own = got[i]
        assert (n, removed, n_spans, bytes(own)) == (len(b), int(gone.sum()), spans, kept)


def test_factor_lengths():
    rng = np.random.default_rng(2)
    for _ in range(60):
        rows = rng.integers(0, 2, (rng.integers(1, 30), rng.integers(1, 6))).astype(np.uint8)
        n, width = rows.shape
        shared = lambda a, b: next((k for k in range(width) if rows[a][k] != rows[b][k]), width)  # noqa: E731,B023
        previous, following = suffix_dedup.factor_lengths(rows)
        assert previous.tolist() == [max([shared(i, j) for j in range(i)], default=0) for i in range(n)]
        assert following.tolist() == [max([shared(i, j) for j in range(i + 1, n)], default=0) for i in range(n)]


@pytest.mark.parametrize("block_bytes", [200, 1 << 20])
def test_decontamination(spark, docs, stage, block_bytes):
    texts = dict(hard_texts())
    items = [(None, "two"), (1, "One"), (2, None), (3, "..."), (7, " ".join(texts[4].split()[5:40])), (10, "def ghi"), (11, "def-ghi")]
    table = spark.createDataFrame(items, "item_id long, text string")
    hits = decontaminate.find_hits(docs, table, stage, block_bytes=block_bytes)
    located = decontaminate.find_spans(docs.drop("spans"), table, stage, block_bytes=block_bytes)
    got, spans = by_id(decontaminate.judged(hits)), {row.doc_id: row.spans for row in located.collect()}
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    for i, t in texts.items():
        w, hit, found = cut(t), set(), set()
        for item, text in items:
            x = cut(text)
            for window in {tuple(x[k : k + 13]) for k in range(max(1, len(x) - 12))} if x else ():
                for k in range(len(w) - len(window) + 1):
                    if tuple(w[k : k + len(window)]) == window:
                        hit.update(range(k, k + len(window)))
                        found.add(str(item))
        bad = bool(hit) and 20 * len(hit) >= len(w)
        assert got[i] == (len(w), len(hit), len(found), sha(",".join(sorted(found))), bad)
        assert [x for s in spans[i] for x in cut(t[s.start : s.end])] == [w[k] for k in sorted(hit)]


def test_lines(spark, stage):
    rng = random.Random(9)
    rows = [(0, None), (1, ""), (2, "short\nshort\n\n\nshort")]
    line = lambda: "".join(rng.choices("abcdé ", k=rng.choice((2, 7, 19, 30, 40))))
    for i in range(40):
        a = line()
        k = rng.randrange(len(a))
        near = rng.choice([a[:k] + a[k + 1 :], a[:k] + "Q" + a[k:], a[:k] + "Q" + a[k + 1 :], a[:k] + "QQ" + a[k:]])
        rows.append((10 + i, "\n".join([a, line(), near, "tail"])))
        rows.append((100 + i, near + "\n" + near[:3] + "Z" + near[4:]))
        rows.append((200 + i, "Zz"[i % 2] + str(i % 7)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(line_dedup.remove_lines(df, stage))
    earlier: list[str] = []
    for i, t in sorted(rows):
        lines = (t or "").split("\n")
        kept = []
        for x in lines:
            near = any(line_dedup.within_one_edit(x, y) for y in earlier)
            if not x or not (near or x in earlier):
                kept.append(x)
            if x:
                earlier.append(x)
        assert got[i] == (len(lines), len(lines) - len(kept), "\n".join(kept))


@pytest.mark.parametrize("heavy, pairs", [(1 << 17, 1 << 11), (200, 50)])
def test_language_model(docs, stage, monkeypatch, heavy, pairs):
    monkeypatch.setattr(lm_score, "HEAVY", heavy)
    monkeypatch.setattr(lm_score, "PAIRS", pairs)
    got = by_id(lm_score.score_documents(docs, stage))
    tokens = {i: ["<s>", *(t or "").encode().split(), "</s>"] for i, t in hard_texts()}
    one = collections.Counter(x for t in tokens.values() for x in t)
    two = collections.Counter(p for t in tokens.values() for p in zip(t, t[1:]))
    total = sum(one.values()) - one["<s>"]
    for i, t in tokens.items():
        score = 0.0
        for (h, w), tf in collections.Counter(zip(t, t[1:])).items():
            c = two[h, w]
            score += tf * math.log10((c - tf) / (one[h] - tf) if c > tf else 0.4 * max(one[w] - tf, 0.5) / total)
        assert got[i][0] == len(t) - 1
        assert got[i][1] == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_components_of_chains_and_stars(spark, stage):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(20)] + [(7, 7), (55, 54), (54, 55)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = by_id(components(df, stage))
    assert found == {i: (0,) for i in range(1, 31)} | {100 + i: (100,) for i in range(1, 20)} | {55: (54,)}


def test_toxicity_on_held_out_rows(spark, stage):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = labels.selectExpr("doc_id", "1 - quality AS low_quality", "toxic")
    chain = toxicity.train(docs, judged.filter("doc_id % 3 > 0"), stage, ("low_quality", "toxic"))
    truth = {row.doc_id: row.toxic for row in labels.filter("doc_id % 3 = 0").collect()}
    got = {row.doc_id: row.toxic for row in toxicity.score(docs, chain).collect()}
    right = sum(got[i] == bool(t) for i, t in truth.items())
    assert right >= 0.93 * len(truth)


def test_languages_of_documents_and_pages(spark):
    got = language_id.op7_language_id(spark, "/root/testdata/sf0.001").collect()
    assert sum(row.language == row.declared for row in got) >= 0.99 * len(got)
    assert all(row.accepted for row in got)


def test_language_without_evidence(docs, empty, stage):
    judged = language_id.identify(language_id.of_documents(docs), language_id.labels_of(docs), stage)
    accepted = {row.doc_id: row.accepted for row in judged.collect()}
    assert not accepted[0] and not accepted[1] and not accepted[2] and accepted[4]
    none = language_id.identify(language_id.of_documents(docs), language_id.labels_of(empty), stage)
    assert {row.accepted for row in none.collect()} == {False}


def test_empty_tables(spark, docs, empty, no_items, stage):
    labels = spark.createDataFrame([], "doc_id long, low_quality int, toxic int")
    chain = toxicity.train(empty.select("doc_id", "text"), labels, stage, ("low_quality", "toxic"))
    assert toxicity.score(empty, chain).count() == 0 and toxicity.score(docs, chain).count() == docs.count()
    assert bpe.round_trip(empty, bpe.vocabulary_path()).count() == 0
    assert jaccard_join.near_duplicates(empty, stage).count() == 0
    assert substring_dedup.remove_repeats(empty, stage).count() == 0
    assert suffix_dedup.remove_repeats(empty, stage).count() == 0
    assert decontaminate.find_hits(docs, no_items, stage).filter("size(hit_words) > 0").count() == 0
    assert line_dedup.remove_lines(empty, stage).count() == 0
    assert exact_dedup.find_copies(empty, stage).count() == 0
    assert lm_score.score_documents(empty, stage).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_agrees_with_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = con.execute(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, folder)
    got = got.select(*(column[0] for column in result.description))
    assert sorted(map(tuple, got.collect())) == sorted(result.fetchall())


def test_pipeline_keeps_what_brute_force_keeps(spark, stage):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    groups = collections.defaultdict(list)
    for i, t in texts.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append(i)
    left = sorted(min(g, key=lambda k: (-len(texts[k]), k)) for g in groups.values())
    sets = {}
    for i in left:
        w = texts[i].encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    parent = {i: i for i in left}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in left:
        for b in left:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    hits = decontaminate.find_hits(docs, spark.read.parquet(f"{folder}/benchmark.parquet"), stage)
    bad = {row.doc_id for row in decontaminate.judged(hits).filter("contaminated").collect()}
    got = {row.doc_id for row in corpus_pipeline.run(spark, folder).collect()}
    assert got == {i for i in left if root(i) == i} - bad
