"""Run detection, importance resampling and SimHash groups against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from siftwork.llm import importance, period_runs, simhash_groups
from siftwork.plans.stage import Stage

SCHEMA = (
    "doc_id long, text string, lang string, n int, words string, h int, runs int, fp long, part int, "
    "score string, node long, component long, place int"
)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def hard_rows() -> list[tuple[int | None, str | None]]:
    """Nulls, repeated ids and rows, empty, blank, periodic and long texts, near copies."""
    rng = random.Random(11)
    vocabulary = [a + b for a in "ba do mi la tu né Sß".split() for b in "ran sel pik tor vo".split()]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = text(260)
    out: list[str | None] = [None, "", " \t\r\n\x0b\x0c", "one", "one two", "a a a a a", "A a a a a a", base, base]
    out += ["a " * 40, "ab cd " * 30 + "ab", "x y z " * 4, "x y z " * 4 + "x y", "p q p q p q p", "... -- !", "日本 語 " * 9]
    for k in range(8):
        words = base.split()
        words[30 * k + 1] = f"edit{k}"
        out.append(" ".join(words))
    for _ in range(12):
        unit = text(rng.randint(1, 7)) + " "
        out.append(text(rng.randint(0, 30)) + " " + unit * rng.randint(2, 9) + text(rng.randint(0, 20)) + " " + unit * 5)
    out += [text(40) for _ in range(120)]
    out += [" ".join("ab"[bin(i).count("1") & 1] for i in range(600)), "w" * 3000 + " " + "v" * 200, text(200_000)]
    rows = list(enumerate(out))
    return rows + [(None, base), (None, None), (7, base), (7, "z " * 30), (3, "one")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", 1, "w", 2, 3, 4, 5, "s", 6, 7, 8) for i, t in hard_rows()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def in_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def runs_by_force(words: list[str]) -> list[tuple[int, int, int]]:
    least: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                least.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in least.items())


def without_repeats(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def short(rows, most: int = 5000):
    return [(i, t) for i, t in rows if len(t or "") <= most]


@pytest.mark.parametrize("block_words", [50, 1 << 17])
def test_runs(spark, docs, block_words, monkeypatch):
    monkeypatch.setattr(period_runs, "BLOCK_WORDS", block_words)
    few = docs.filter("text is null or length(text) <= 5000")
    got = collections.Counter(
        (r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in period_runs.find_runs(few).collect()
    )
    expected = collections.Counter()
    for i, t in short(hard_rows()):
        words = in_words(t)
        runs = runs_by_force(words)
        expected[i, len(words), tuple(runs), without_repeats(words, runs)] += 1
    assert got == expected
    assert sum(len(key[2]) for key in expected) > 20


def test_runs_of_random_blocks(monkeypatch):
    monkeypatch.setattr(period_runs, "TRIED", 37)
    rng = random.Random(4)
    for _ in range(150):
        block = []
        for _ in range(rng.randint(0, 4)):
            words = [rng.randrange(rng.choice((1, 2, 3))) for _ in range(rng.choice((0, 1, 9, 80)))]
            block.append(words + words[: rng.randint(0, 9)] * rng.randint(0, 9) + words)
        ids = np.array([w for words in block for w in words], dtype=np.int64)
        owner = np.repeat(np.arange(len(block)), [len(words) for words in block])
        expected, base = [], 0
        for words in block:
            expected += [(s + base, n, q) for s, n, q in runs_by_force(words)]
            base += len(words)
        assert sorted(zip(*map(np.ndarray.tolist, period_runs.runs_of_block(ids, owner)))) == sorted(expected)


def test_strings_without_and_with_many_periods():
    one = lambda ids: period_runs.runs_of_block(np.array(ids), np.zeros(len(ids), dtype=np.int64))
    # Thue-Morse words have no cube; their hashes modulo powers of two would collide.
    assert not len(one([bin(i).count("1") & 1 for i in range(1 << 13)])[0])
    assert [x.tolist() for x in one([3] * 50_000)] == [[0], [50_000], [1]]
    assert [x.tolist() for x in one([*range(5000)] * 4)] == [[0], [20_000], [5000]]
    assert not len(one([*range(5000)] * 3)[0])
    with pytest.raises(ValueError):
        period_runs.runs_of_block(np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64), 6, 3)


def digest_by_force(i: int | None, text: str | None) -> tuple:
    words = in_words(text)
    n = len(words)
    h = None if i is None else zlib.crc32(str(i).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    runs = runs_by_force(words)
    best = min(((-m, s, q) for s, m, q in runs), default=None)
    longest = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return i, len(runs), *longest, sha(listed), sha(without_repeats(words, runs))


def test_planted_periods_and_digests(spark, docs):
    few = docs.filter("text is null or length(text) <= 5000")
    got = period_runs.digests(period_runs.find_runs(period_runs.with_periods(few)))
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    expected = [digest_by_force(i, t) for i, t in short(hard_rows())]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(expected)


def test_op11_on_a_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in period_runs.op11_period_runs(spark, folder).collect()}
    assert got == {r.doc_id: digest_by_force(r.doc_id, r.text) for r in rows}


def test_crcs_of_spans():
    rng = random.Random(2)
    data = bytes(rng.randrange(256) for _ in range(6000))
    sizes = [1, 2, 3, 4, 5, 63, 64, 65, 127, 128, 129, 192, 193, 4001, 6000] + [rng.randint(1, 300) for _ in range(200)]
    starts = [rng.randint(0, 6000 - n) for n in sizes]
    ends = [s + n for s, n in zip(starts, sizes)]
    got = importance.span_crcs(np.frombuffer(data, np.uint8), np.array(starts), np.array(ends))
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in zip(starts, ends)]


def features(text: str | None, most: int) -> tuple[int, list[int]]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(words[k : k + n]) for n in range(1, most + 1) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(f.encode()) for f in runs]


def resampled_by_force(rows, items, most=1, buckets=10_000, min_words=20, percent=10) -> collections.Counter:
    source = collections.Counter(c % buckets for _, t in rows for c in features(t, most)[1])
    target = collections.Counter(c % buckets for t in items for c in features(t, most)[1])
    s_all, t_all = sum(source.values()), sum(target.values())
    gain = lambda b: math.floor(1000 * math.log((target[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets))))
    gains = {b: gain(b) for b in source}
    scored = []
    for i, t in rows:
        n, found = features(t, most)
        weight = sum(gains[c % buckets] for c in found)
        h = int(sha(f"2024:{'' if i is None else i}")[:8], 16)
        scored.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in scored if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0], r[2]))
    ranked = [(*r, k + 1 if k < percent * len(order) // 100 else None) for k, r in enumerate(order)]
    return collections.Counter(ranked + [(*r, None) for r in scored if r[1] < min_words])


@pytest.mark.parametrize("most, percent, partitions", [(1, 10, 4), (3, 60, 1)])
def test_resampling(spark, docs, stage, most, percent, partitions, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK_BYTES", 3000)
    items = ["ba do", "bator doran Mivo " * 20, None, "", "dosel dosel"]
    target = spark.createDataFrame([(t, 1) for t in items], "text string, doc_id int")
    got = importance.resample(docs.repartition(partitions), target, stage, max_words=most, percent=percent)
    expected = resampled_by_force(hard_rows(), items, most=most, percent=percent)
    assert collections.Counter(map(tuple, got.collect())) == expected


def test_op12_on_a_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = collections.Counter(map(tuple, importance.op12_importance(spark, folder).collect()))
    expected = resampled_by_force(rows, items)
    assert got == collections.Counter({(k[0], *k[2:]): n for k, n in expected.items()})


def fingerprint_by_force(text: str | None, width: int = 3) -> int:
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    shingles = [words[k : k + width] for k in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped_by_force(prints: list[tuple[int | None, int]], most: int = 3) -> list[tuple]:
    distinct = sorted({fp for _, fp in prints})
    parent = {fp: fp for fp in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if (a ^ b).bit_count() <= most:
                parent[root(a)] = root(b)
    least: dict[int, int | None] = {}
    for i, fp in prints:
        r = root(fp)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [(i, fp, least[root(fp)]) for i, fp in prints]


@pytest.mark.parametrize("block", [3, 2048])
def test_simhash_groups(docs, stage, block):
    got = simhash_groups.near_duplicates(docs, stage, block=block).collect()
    found = collections.Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got)
    expected = grouped_by_force([(i, fingerprint_by_force(t)) for i, t in hard_rows()])
    assert found == collections.Counter(expected)
    assert len({row[2] for row in expected}) < len({row[1] for row in expected})


@pytest.mark.parametrize("most", [0, 1, 3, 5])
def test_links_of_close_fingerprints(spark, stage, most):
    rng = random.Random(most)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for fp in prints[:40]:
        for _ in range(rng.randint(1, 6)):
            prints.append(fp ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, most + 2))))
    prints += [0, 2**64 - 1, 1, 2**63]
    signed = sorted({fp - 2**64 if fp >> 63 else fp for fp in prints})
    df = spark.createDataFrame([(fp,) for fp in signed], "fp long")
    from siftwork.llm.components import components

    links = simhash_groups.find_links(df, stage, max_distance=most, block=4)
    found = {r.node: r.component for r in components(stage.table(links, "l"), stage).collect()}
    groups = collections.defaultdict(set)
    for fp in signed:
        groups[found.get(fp, fp)].add(fp % 2**64)
    expected = collections.defaultdict(set)
    for i, fp, least in grouped_by_force(list(enumerate(sorted(fp % 2**64 for fp in signed))), most):
        expected[least].add(fp)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_a_dense_cluster_sends_a_tree(spark):
    fps = np.array([sum(1 << b for b in {i % 64, i // 64}) for i in range(2048)], dtype=np.uint64).view(np.int64)
    fps = np.unique(fps)
    n = np.array([len(fps)])
    a, _ = simhash_groups.linked_pairs(fps, fps, n, n, 3)
    assert len(a) == len(fps) - 1


def test_op13_on_a_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = grouped_by_force([(r.doc_id, fingerprint_by_force(r.text)) for r in rows])
    got = simhash_groups.op13_simhash(spark, folder).collect()
    assert sorted(map(tuple, got)) == sorted((i, f"{fp:016x}", c) for i, fp, c in expected)


def test_empty_tables(spark, empty, docs, stage):
    assert period_runs.digests(period_runs.find_runs(period_runs.with_periods(empty))).count() == 0
    assert importance.resample(empty, empty, stage).count() == 0
    assert importance.resample(docs, empty, stage).count() == docs.count()
    assert simhash_groups.near_duplicates(empty, stage).count() == 0


def test_staged_tables_lie_in_the_shared_folder(spark):
    assert Stage(spark).uri.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
