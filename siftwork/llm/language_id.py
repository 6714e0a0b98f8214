"""Language identification by fusing independent pieces of evidence in Bayes' rule.

Evidence for each language: the text's likelihood under byte trigrams, the language that the
markup or a column declares, the suffix or path part of the address, and a prior from the host.
Declarations and addresses err, so their likelihoods are learned: grouped counts of what is declared
against what the text says. A host's prior is smoothed towards its domain's, and that towards the
prior of all; each is a grouped count too, and a document's own vote is taken out of it. One more
hypothesis is that the language is none of those known: its text is as likely as chance, and a declaration
that no language has a table for speaks for it.

Trigram tables are fitted on a bounded sample of labelled rows (``TRAIN_ROWS``), about as many of each
language, so that none is left out; a table's counts are smoothed towards those of all languages together, which
decides for a language of few rows. All other counts cover all rows. Text evidence is tempered: neighbouring
trigrams depend on each other.

A document is accepted if the best hypothesis is a language and its posterior reaches ``ACCEPT``. Null and
empty texts, and texts without letters, carry no text evidence and are not accepted; they keep the prior's
language. Null declarations, addresses and hosts carry no evidence. Of languages that are as likely the one
later in the alphabet is named. Decisions follow from text, declaration and host alone, so rows that share an id, or
have none, are judged one by one. Other columns are not read, whatever their names (``__siftwork_`` is
taken). Without a labelled row there is no language, and nothing is accepted.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm.common import batches_of, give_back, read, small
from siftwork.plans.stage import Stage

#: Labelled rows on which the trigram tables are fitted, about.
TRAIN_ROWS = 8_000
BUCKETS = 1 << 15
#: Trigrams of all languages that a language's own counts are smoothed with.
SMOOTHING = 1000.0
#: Tables that a task adds up before it hands them on.
TABLES_AT_ONCE = 64
#: Prior of a language that is none of those known, and the trigrams over which chance spreads its texts.
UNKNOWN, CHANCE_TRIGRAMS = 0.001, BUCKETS / 3
#: Weight of the text: as of so many independent trigrams, at most.
TEXT_WEIGHT = 40.0
#: Pseudo-counts: of a domain's prior in a host's, of all in a domain's, and of a declaration.
HOST_WEIGHT, DOMAIN_WEIGHT, DECLARED_WEIGHT = 10.0, 50.0, 5.0
ACCEPT = 0.6
_H = "__siftwork_"

_TAGS = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;")
#: Bytes of letters, lower-cased; everything else is one blank.
_FOLDED = np.array(
    [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)],
    dtype=np.uint32,
)


def trigrams(text: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of a text, blanks merged."""
    codes = _FOLDED[np.frombuffer(text, dtype=np.uint8)]
    codes = np.concatenate(([32], codes, [32])).astype(np.uint32)
    blank = codes == 32
    codes = codes[~(blank & np.concatenate(([False], blank[:-1])))]
    if len(codes) < 3:
        return np.zeros(0, dtype=np.int64)
    mix = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA6B)
    mix = (mix + codes[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    return (mix >> np.uint32(17)).astype(np.int64)


def strip_markup(html: str) -> str:
    return _TAGS.sub(" ", html)


def subtag(column: Column) -> Column:
    """The primary language subtag of a declaration, such as en of en-GB."""
    tag = F.lower(F.regexp_extract(column.cast("string"), r"^\s*([A-Za-z]{2,3})\b", 1))
    return F.when(tag != "", tag)


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def domain_of(host: Column) -> Column:
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    return F.when(domain != "", domain).otherwise(host)


def suffix_of(url: Column) -> Column:
    """A language-like part of the address: first path segment of two letters, else the TLD."""
    path = F.lower(F.regexp_extract(url, r"://[^/]+/([A-Za-z]{2})(?:[/?#]|$)", 1))
    tld = F.lower(F.regexp_extract(host_of(url), r"\.([a-z]{2,})$", 1))
    return F.when(path != "", F.concat(F.lit("/"), path)).when(tld != "", F.concat(F.lit("."), tld))


def fit_trigrams(labelled: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log likelihoods by bucket and language) from columns label and text.

    Labels are subtags of two or three letters, which bounds their number; each has a table of
    ``BUCKETS`` numbers.
    """
    known = labelled.filter("label is not null and text is not null")
    counted = known.groupBy("label").count().collect()
    quota = max(1, rows // max(len(counted), 1))
    shares = [(row.label, min(1_000_000, quota * 1_000_000 // row["count"] + 1)) for row in counted]
    chosen = known.join(
        F.broadcast(known.sparkSession.createDataFrame(shares, "of_label string, share bigint")),
        F.col("label") == F.col("of_label"),
    ).filter(F.pmod(F.xxhash64("text", "label"), F.lit(1_000_000)) < F.col("share"))
    schema = pa.schema([("label", pa.string()), ("counts", pa.binary())])

    def count(batches):
        sums: dict[str, np.ndarray] = {}

        def handed_on():
            return batches_of(((k, v.astype(np.int32).tobytes()) for k, v in sums.items()), schema)

        for batch in small(batches):
            for label, text in zip(*(c.to_pylist() for c in batch.columns)):
                sums[label] = sums.get(label, 0) + np.bincount(trigrams(text.encode()), minlength=BUCKETS)
                if len(sums) > TABLES_AT_ONCE:
                    yield from handed_on()
                    sums = {}
        yield from handed_on()

    parts = chosen.select("label", "text").mapInArrow(count, "label string, counts binary")

    def merge(key, table):
        total = sum(np.frombuffer(x, dtype=np.int32).astype(np.int64) for x in table["counts"].to_pylist())
        return pa.table({"label": [key[0].as_py()], "counts": [total.astype(np.int64).tobytes()]}, schema=schema)

    found = parts.groupBy("label").applyInArrow(merge, "label string, counts binary").collect()
    # A language may have no row in the sample by chance; it has the counts of all, then.
    counts = {label: np.zeros(BUCKETS) for label, _ in shares}
    counts |= {row.label: np.frombuffer(row.counts, dtype=np.int64).astype(float) for row in found}
    languages = sorted(counts)
    everything = sum(counts.values(), np.zeros(BUCKETS)) + 0.5
    everything /= everything.sum()
    table = np.zeros((BUCKETS, len(languages)), dtype=np.float32)
    for i, label in enumerate(languages):
        own = counts[label]
        table[:, i] = np.log((own + SMOOTHING * everything) / (own.sum() + SMOOTHING))
    return languages, table


def score_texts(docs: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """Keeps all columns but text, and adds n_trigrams, evidence (log likelihoods, last that of chance) and vote."""
    model = docs.sparkSession.sparkContext.broadcast(table)
    others = [c for c in docs.columns if c not in ("text", "is_markup")]

    def score(batches):
        for batch in small(batches):
            texts, markup = batch.column("text").to_pylist(), batch.column("is_markup").to_pylist()
            sizes, evidence, votes = [], [], []
            for text, marked in zip(texts, markup):
                grams = trigrams((strip_markup(text) if marked else text).encode())
                n = len(grams)
                sizes.append(n)
                if not n or not languages:
                    evidence.append([0.0] * (len(languages) + 1))
                    votes.append(None)
                    continue
                mean = model.value[grams].sum(axis=0, dtype=np.float64) / n
                weight = min(TEXT_WEIGHT, n)
                chance = -np.log(CHANCE_TRIGRAMS)
                evidence.append((weight * (np.append(mean, chance) - mean.max())).tolist())
                votes.append(languages[int(mean.argmax())])
            columns = [batch.column(c) for c in others]
            columns += [pa.array(sizes, pa.int64()), pa.array(evidence, pa.list_(pa.float64())), pa.array(votes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*others, "n_trigrams", "evidence", "vote"])
        give_back()

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*others).schema)
    return docs.mapInArrow(score, f"{kept}, n_trigrams bigint, evidence array<double>, vote string")


def _votes(scored: DataFrame, by: str, languages: list[str]) -> DataFrame:
    """Per value of ``by``: its votes for each language, as an array."""
    sums = [F.sum((F.col("vote") == x).cast("double")) for x in languages]
    counted = scored.filter(F.col(by).isNotNull() & F.col("vote").isNotNull()).groupBy(by)
    return counted.agg(F.array(*sums).alias(f"{by}_votes"))


def fuse(scored: DataFrame, languages: list[str], stage: Stage) -> DataFrame:
    """Adds language, posterior and accepted to the columns of ``score_texts``."""
    if not languages:
        return scored.select(
            "*", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted")
        )
    scored = stage.table(scored, "scored", "zstd")
    # Written as they are, so that the planner sees which are small enough to broadcast.
    votes = stage.key_sets({by: _votes(scored, by, languages) for by in ("host", "domain", "declared", "suffix")})
    sums = [F.sum((F.col("vote") == x).cast("double")) for x in languages]
    everything = [float(x or 0) for x in scored.agg(*sums).first()]
    n_all = sum(everything)
    joined = scored
    for by, counted in votes.items():
        joined = joined.join(counted, by, "left")
    tags = {by: votes[by].count() + 1.0 for by in ("declared", "suffix")}
    modelled = F.col("declared").isin(*languages)
    scores = []
    for i, language in enumerate(languages):
        own = F.when(F.col("vote") == language, 1.0).otherwise(0.0)
        voted = F.when(F.col("vote").isNotNull(), 1.0).otherwise(0.0)

        def count(by, i=i, own=own):
            return F.coalesce(F.col(f"{by}_votes")[i] - own, F.lit(0.0))

        def total(by, voted=voted):
            whole = F.aggregate(f"{by}_votes", F.lit(0.0), lambda x, y: x + y)
            return F.coalesce(whole - voted, F.lit(0.0))

        prior = (everything[i] + 1.0) / (n_all + len(languages))
        domain = (count("domain") + DOMAIN_WEIGHT * prior) / (total("domain") + DOMAIN_WEIGHT)
        host = (count("host") + HOST_WEIGHT * domain) / (total("host") + HOST_WEIGHT)
        score = F.col("evidence")[i] + F.log(host)
        for by in ("declared", "suffix"):
            likelihood = (count(by) + DECLARED_WEIGHT / tags[by]) / (everything[i] + DECLARED_WEIGHT)
            score = score + F.when(F.col(by).isNotNull(), F.log(likelihood)).otherwise(0.0)
        scores.append(F.struct(score.alias("score"), F.lit(language).alias("language")))
    # Of a language that is not known, any declaration is as likely, and one without a table likelier.
    none = F.col("evidence")[len(languages)] + float(np.log(UNKNOWN))
    none = none + F.when(F.col("declared").isNull(), 0.0).when(modelled, float(-np.log(tags["declared"]))).otherwise(float(np.log(0.5)))
    none = none - F.when(F.col("suffix").isNull(), 0.0).otherwise(float(np.log(tags["suffix"])))
    scores.append(F.struct(none.alias("score"), F.lit(None).cast("string").alias("language")))
    best = F.array_max(F.array(*scores))
    fused = joined.select(*scored.columns, F.array(*scores).alias("scores"), best.alias("best"))
    mass = F.aggregate("scores", F.lit(0.0), lambda x, y: x + F.exp(y["score"] - F.col("best.score")))
    fused = fused.withColumn("posterior", 1.0 / mass).withColumn("language", F.col("best.language"))
    accepted = (F.col("n_trigrams") > 0) & (F.col("posterior") >= ACCEPT) & F.col("language").isNotNull()
    return fused.withColumn("accepted", accepted).drop("scores", "best")


def of_documents(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Evidence of documents: their text, the language column and the source as host."""
    return docs.select(
        *carry,
        docs["doc_id"].cast("bigint").alias("doc_id"),
        F.lit(None).cast("bigint").alias("page_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
        F.lit(False).alias("is_markup"),
        subtag(docs["lang"]).alias("declared"),
        F.lit(None).cast("string").alias("suffix"),
        docs["source"].cast("string").alias("host"),
        F.lit(None).cast("string").alias("domain"),
    )


def of_pages(pages: DataFrame) -> DataFrame:
    """Evidence of pages: text without markup, the declared language, address and host."""
    tag = F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    return pages.select(
        F.lit(None).cast("bigint").alias("doc_id"),
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("text"),
        F.lit(True).alias("is_markup"),
        subtag(tag).alias("declared"),
        suffix_of(F.col("url")).alias("suffix"),
        host_of(F.col("url")).alias("host"),
        domain_of(host_of(F.col("url"))).alias("domain"),
    )


def identify(evidence: DataFrame, labelled: DataFrame, stage: Stage) -> DataFrame:
    """Language, posterior and acceptance for rows of ``of_documents`` or ``of_pages``."""
    languages, table = fit_trigrams(labelled)
    return fuse(score_texts(evidence, languages, table), languages, stage)


def labels_of(docs: DataFrame) -> DataFrame:
    return docs.select(subtag(docs["lang"]).alias("label"), docs["text"].cast("string").alias("text"))


def _content(docs: DataFrame, names: tuple[str, str]) -> dict[str, Column]:
    """Two hashes of all that the decision on a document rests on."""
    judged = [docs[name].cast("string") for name in ("text", "lang", "source")]
    return {name: F.xxhash64(F.lit(i), *judged) for i, name in enumerate(names)}


def keep_identified(docs: DataFrame, stage: Stage) -> DataFrame:
    """The documents that are accepted, with all their columns.

    The refused are told by two hashes of text, declaration and source, which are all that the decision
    rests on; so a row is never dropped for the id it shares, and only hashes are shuffled.
    """
    own, other = (_H + "a", _H + "b"), (_H + "c", _H + "d")
    keyed = of_documents(docs.withColumns(_content(docs, own)), own)
    refused = identify(keyed, labels_of(docs), stage).filter("not accepted").select(*own).distinct()
    refused = stage.key_sets({"refused": refused.toDF(*other)})["refused"]
    same = (F.col(own[0]) == F.col(other[0])) & (F.col(own[1]) == F.col(other[1]))
    return docs.withColumns(_content(docs, own)).join(refused, same, "left_anti").select(*docs.columns)


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """All documents and all pages; a row has either a doc_id or a page_id."""
    docs, pages = read(spark, folder, "documents"), read(spark, folder, "pages")
    evidence = of_documents(docs).union(of_pages(pages))
    judged = identify(evidence, labels_of(docs), Stage(spark))
    return judged.select("doc_id", "page_id", "declared", "language", "posterior", "accepted")
