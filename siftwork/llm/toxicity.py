"""Toxicity by a classifier chain of linear models.

The chain predicts the judged categories one after the other. Each link is a logistic regression
on the words and word beginnings of a text, and on the log odds that the earlier links give. In
training these come from models that did not see the row (out-of-fold predictions), so later links
learn how far earlier ones can be trusted. The last link is toxicity itself.

Features are found by grouped counts: a sketch of hashed features against the categories names
the buckets that tell most, and the features in these are then counted exactly; the best
``FEATURES`` of them make the vocabulary. Models are fitted on a bounded sample of labelled rows
(``TRAIN_ROWS``); every document is scored whole.

Null and empty texts have no features and get the probabilities of a text without any. Labels of
null count as not judged, those above zero as one; of several judgements of one document the highest
holds, category by category. Repeated rows are scored each. Without labels, or with a category that is
all the same, a link predicts the share of its label. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm.common import (
    BYTE_VALUES,
    IS_SPACE,
    RollingHashes,
    batches_of,
    id_and_text,
    read,
    records,
)
from siftwork.llm.decontaminate import PLAIN
from siftwork.plans.stage import Stage

#: Labelled rows on which the chain is fitted, about.
TRAIN_ROWS = 20_000
#: Features of the vocabulary, buckets that are looked into for them, and rows that must have one.
FEATURES, CANDIDATES, MIN_ROWS = 3_000, 12_000, 4
SKETCH_BITS = 18
FOLDS = 3
#: Bytes of the word beginnings that are features.
BEGINNINGS = (4, 5)
STEPS, RATE, PENALTY = 150, 0.15, 1.0
#: Likelihood-ratio root that a feature must reach, as of so many standard deviations.
SURE = 4.0

_letters = RollingHashes(0x5851F42D4C957F2D)


def features_of(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the words of a text and of their first bytes."""
    data = np.frombuffer(text.translate(PLAIN), dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sums = _letters.sums(BYTE_VALUES[data])
    found = [_letters.stretches(sums, starts, ends)]
    for size in BEGINNINGS:
        long = ends - starts > size
        begun = _letters.stretches(sums, starts[long], starts[long] + size)
        found.append(begun * np.uint64(2 * size + 1))
    return np.unique(np.concatenate(found))


def weight_of_evidence(present: np.ndarray, positive: np.ndarray, n: float, n_positive: float):
    """How surely a feature's rows are not a chance draw: the root of the likelihood ratio."""
    share = min(max(n_positive / max(n, 1.0), 1e-9), 1 - 1e-9)
    own = positive / np.maximum(present, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(positive > 0, positive * np.log(own / share), 0.0)
        gain += np.where(positive < present, (present - positive) * np.log((1 - own) / (1 - share)), 0.0)
    return np.sqrt(np.maximum(2 * gain, 0.0))


@dataclass(frozen=True)
class Link:
    weights: np.ndarray  # of the vocabulary's features
    chained: np.ndarray  # of the earlier links' log odds
    bias: float

    def log_odds(self, rows: np.ndarray, columns: np.ndarray, n: int, earlier: np.ndarray):
        linear = np.bincount(rows, weights=self.weights[columns], minlength=n)
        return linear + earlier @ self.chained + self.bias


@dataclass(frozen=True)
class Chain:
    names: tuple[str, ...]
    vocabulary: np.ndarray  # sorted feature hashes
    links: tuple[Link, ...]
    thresholds: tuple[float, ...]

    def log_odds(self, rows: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, len(self.links)))
        for i, link in enumerate(self.links):
            out[:, i] = link.log_odds(rows, columns, n, out[:, :i])
        return out


def fit_link(rows, columns, earlier: np.ndarray, labels: np.ndarray, size: int) -> Link:
    """Logistic regression by Adam steps over all rows; labels are 0 and 1."""
    n, k = earlier.shape
    share = (labels.sum() + 0.5) / (n + 1.0)
    theta = np.zeros(size + k + 1)
    theta[-1] = np.log(share / (1 - share))
    if not 0 < labels.sum() < n:
        return Link(theta[:size], theta[size:-1], float(theta[-1]))
    scale = np.maximum(np.abs(earlier).max(axis=0, initial=1.0), 1.0)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        link = Link(theta[:size], theta[size:-1] / scale, float(theta[-1]))
        error = 1.0 / (1.0 + np.exp(-np.clip(link.log_odds(rows, columns, n, earlier), -30, 30)))
        error = (error - labels) / n
        slope = np.empty_like(theta)
        slope[:size] = np.bincount(columns, weights=error[rows], minlength=size)
        slope[size:-1] = (earlier / scale).T @ error
        slope[-1] = error.sum()
        slope[:-1] += PENALTY * theta[:-1] / n
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return Link(theta[:size], theta[size:-1] / scale, float(theta[-1]))


def fit_chain(names, vocabulary, rows, columns, folds: np.ndarray, labels: np.ndarray) -> Chain:
    """Links in the order of ``names``; ``labels`` has a column for each."""
    n, size = len(folds), len(vocabulary)
    order = np.argsort(rows, kind="stable")
    rows, columns = rows[order], columns[order]
    held_out = np.zeros((n, len(names)))
    links, thresholds = [], []
    for i in range(len(names)):
        for fold in range(FOLDS):
            train = np.flatnonzero(folds != fold)
            place = np.full(n, -1)
            place[train] = np.arange(len(train))
            inside = place[rows] >= 0
            link = fit_link(
                place[rows[inside]], columns[inside], held_out[train, :i], labels[train, i], size
            )
            test = np.flatnonzero(folds == fold)
            held_out[test, i] = link.log_odds(rows, columns, n, held_out[:, :i])[test]
        links.append(fit_link(rows, columns, held_out[:, :i], labels[:, i], size))
        thresholds.append(best_threshold(held_out[:, i], labels[:, i]))
    return Chain(tuple(names), vocabulary, tuple(links), tuple(thresholds))


def best_threshold(log_odds: np.ndarray, labels: np.ndarray) -> float:
    """The log odds at which out-of-fold predictions have the best F1."""
    order = np.argsort(-log_odds, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum() + 1e-9)
    if not len(order) or not labels.sum():
        return 0.0
    best = int(f1.argmax())
    below = log_odds[order[best + 1]] if best + 1 < len(order) else log_odds[order[best]] - 1.0
    return float((log_odds[order[best]] + below) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, names: tuple[str, ...], rows: int) -> DataFrame:
    """doc_id, text and labels of a sample of about ``rows`` labelled documents."""
    # Of several judgements of one document the highest holds, category by category.
    known = (
        labels.select(F.col("doc_id").alias("labelled_id"), *names)
        .dropna()
        .groupBy("labelled_id")
        .agg(*[F.max((F.col(name) > 0).cast("int")).alias(name) for name in names])
    )
    share = min(1.0, rows / max(known.count(), 1))
    chosen = known.filter(
        F.pmod(F.xxhash64("labelled_id"), F.lit(1_000_000)) < int(share * 1_000_000)
    )
    # The sample's size is bounded by ``rows``, so its ids can be sent to all.
    return docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("labelled_id")).select(
        "doc_id", "text", *[F.col(name).cast("int").alias(name) for name in names]
    )


def choose_vocabulary(sample: DataFrame, names: tuple[str, ...]) -> np.ndarray:
    """The features that tell most about a category, by sketch and then by exact counts."""
    k, context = len(names), sample.sparkSession.sparkContext

    def sketch(batches):
        total = np.zeros((k + 1, 1 << SKETCH_BITS), dtype=np.int64)
        for batch in batches:
            given = [batch.column(2 + i).to_pylist() for i in range(k)]
            for row, (_, text) in enumerate(records([batch])):
                cells = np.unique(features_of(text) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                total[0, cells] += 1
                for i in range(k):
                    if given[i][row]:
                        total[1 + i, cells] += 1
        if total.any():
            yield pa.RecordBatch.from_pydict({"counts": pa.array([total.astype(np.int32).tobytes()])})

    zero = np.zeros((k + 1) << SKETCH_BITS, dtype=np.int64)
    counts = (
        sample.mapInArrow(sketch, "counts binary")
        .rdd.map(lambda row: np.frombuffer(row.counts, dtype=np.int32).astype(np.int64))
        .treeAggregate(zero, lambda a, b: a + b, lambda a, b: a + b)
        .reshape(k + 1, -1)
    )
    sums = [F.sum(name) for name in names]
    n, *positive = [float(x or 0) for x in sample.agg(F.count("*"), *sums).first()]
    score = np.max(
        [np.abs(weight_of_evidence(counts[0], counts[1 + i], n, positive[i])) for i in range(k)], axis=0
    )
    score[counts[0] < MIN_ROWS] = -1.0
    best = np.sort(np.argsort(-score, kind="stable")[:CANDIDATES])
    wanted = np.zeros(1 << SKETCH_BITS, dtype=bool)
    wanted[best[score[best] > 0]] = True
    cells = context.broadcast(wanted)

    def features(batches):
        schema = pa.schema([("feature", pa.int64())] + [(name, pa.int32()) for name in names])

        def rows():
            for batch in batches:
                given = [batch.column(2 + i).to_pylist() for i in range(k)]
                for row, (_, text) in enumerate(records([batch])):
                    found = features_of(text)
                    found = found[cells.value[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]]
                    own = [x[row] for x in given]
                    for feature in found.view(np.int64).tolist():
                        yield feature, *own

        return batches_of(rows(), schema)

    ddl = ", ".join(["feature bigint"] + [f"`{name}` int" for name in names])
    counted = sample.mapInArrow(features, ddl).groupBy("feature").agg(
        F.count("*").alias("n"), *[F.sum(name).alias(name) for name in names]
    )
    table = counted.filter(F.col("n") >= MIN_ROWS).toArrow()
    features = table["feature"].to_numpy()
    present = table["n"].to_numpy().astype(float)
    exact = [
        np.abs(weight_of_evidence(present, table[name].to_numpy().astype(float), n, positive[i]))
        for i, name in enumerate(names)
    ]
    score = np.max(exact, axis=0) if len(features) else np.zeros(0)
    features, score = features[score >= SURE], score[score >= SURE]
    chosen = features[np.lexsort((features, -score))[:FEATURES]]
    return np.sort(chosen.view(np.uint64))


def known_features(text: bytes, vocabulary: np.ndarray) -> np.ndarray:
    """Places in the vocabulary of the features that a text has."""
    found = features_of(text)
    if not len(found) or not len(vocabulary):
        return np.zeros(0, dtype=np.int64)
    places = np.searchsorted(vocabulary, found)
    places[places == len(vocabulary)] = 0
    return places[vocabulary[places] == found]


def train(
    docs: DataFrame, labels: DataFrame, stage: Stage, names: tuple[str, ...], rows: int = TRAIN_ROWS
) -> Chain:
    """``docs`` has doc_id and text; ``labels`` doc_id and a 0/1 column for each name."""
    sample = stage.table(training_rows(docs, labels, names, rows), "sample", "zstd")
    vocabulary = choose_vocabulary(sample, names)
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def matrix(batches):
        fields = [("doc_id", pa.int64()), ("columns", pa.list_(pa.int32()))]
        schema = pa.schema(fields + [(name, pa.int32()) for name in names])

        def rows():
            for batch in batches:
                given = [batch.column(2 + i).to_pylist() for i in range(len(names))]
                for row, (doc_id, text) in enumerate(records([batch])):
                    yield doc_id, known_features(text, known.value), *[x[row] for x in given]

        return batches_of(rows(), schema)

    ddl = ", ".join(["doc_id bigint, columns array<int>"] + [f"`{name}` int" for name in names])
    # Bounded by TRAIN_ROWS rows of places in a vocabulary of FEATURES.
    table = sample.mapInArrow(matrix, ddl).orderBy("doc_id").toArrow()
    lists = table["columns"].combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy()) if table.num_rows else np.zeros(0, dtype=np.int64)
    rows_of = np.repeat(np.arange(table.num_rows), sizes)
    columns = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    judged = [table[name].to_numpy().astype(float) for name in names]
    ids = table["doc_id"].to_numpy().astype(np.uint64)
    folds = ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % FOLDS
    return fit_chain(names, vocabulary, rows_of, columns, folds, np.array(judged).T.reshape(-1, len(names)))


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, a probability p_<name> of each link, and toxic by the last one."""
    model = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{name}" for name in chain.names]
    fields = [("doc_id", pa.int64())] + [(name, pa.float64()) for name in names]
    schema = pa.schema([*fields, ("toxic", pa.bool_())])

    def run(batches):
        own = model.value
        for batch in batches:
            found = [known_features(text, own.vocabulary) for _, text in records([batch])]
            n = len(found)
            if not n:
                continue
            rows = np.repeat(np.arange(n), [len(x) for x in found])
            odds = own.log_odds(rows, np.concatenate(found), n)
            p = 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30)))
            toxic = odds[:, -1] > own.thresholds[-1]
            columns = [batch.column(0), *[pa.array(p[:, i]) for i in range(len(names))], pa.array(toxic)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    ddl = ", ".join(["doc_id bigint"] + [f"`{name}` double" for name in names] + ["toxic boolean"])
    return id_and_text(docs, id_col, text_col).mapInArrow(run, ddl)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A chain from low quality to toxicity, the two categories that the labels judge."""
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    judged = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = train(id_and_text(docs, "doc_id", "text"), judged, Stage(spark), ("low_quality", "toxic"))
    return score(docs, chain)
