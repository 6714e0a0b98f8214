"""Annotation: one pass that notes on each row the rules it breaks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.operators.keys import duplicate_keys, key_column, orphan_keys
from siftwork.operators.rules import (
    DATE_TEXT,
    FOREIGN_KEY,
    RESERVED,
    UNIQUE,
    Rule,
    check_reserved,
    row_violation,
)
from siftwork.plans.stage import Stage, joins_by_shuffle

ISSUES = RESERVED + "issues"
FAULTY = RESERVED + "faulty"


def annotate(
    df: DataFrame,
    rules: Sequence[Rule],
    references: Mapping[str, DataFrame],
    stage: Stage,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add the column ``ISSUES``, the positions in ``rules`` of the rules that the row breaks.

    Rules on the row itself are plain expressions. For uniqueness and foreign keys the
    offending keys are found first, from the key columns alone, and written to ``stage``.
    The rows then look their key up in that table. It holds each key once and is mostly
    small, so Spark, which knows its size from the files, broadcasts it and the wide rows
    are not shuffled. Beyond the broadcast threshold both sides of the sort-merge join
    are plain exchanges, which adaptive execution splits where a key is hot.

    ``keys`` may hold the key columns of ``df`` where reading them from ``df`` costs more.
    """
    found = _key_sets(df if keys is None else keys, rules, references)
    return _look_up_all(df, rules, stage.key_sets(found))


def annotate_all(
    datasets: Mapping[str, DataFrame],
    rules: Mapping[str, Sequence[Rule]],
    stage: Stage,
) -> dict[str, DataFrame]:
    """Annotate every dataset; a dataset without rules has no issues.

    Foreign keys are checked against the whole of the other dataset, rejected rows too.
    The key sets of all datasets are found side by side.
    """
    unknown = [name for name in rules if name not in datasets]
    if unknown:
        raise KeyError(f"Rules name datasets that were not given: {unknown}")
    needed = {
        (name, key): keys
        for name, df in datasets.items()
        for key, keys in _key_sets(df, rules.get(name, ()), datasets).items()
    }
    written = stage.key_sets({f"{name}_{key}": keys for (name, key), keys in needed.items()})
    return {
        name: _look_up_all(
            df,
            rules.get(name, ()),
            {key: written[f"{own}_{key}"] for own, key in needed if own == name},
        )
        for name, df in datasets.items()
    }


def _key_sets(
    df: DataFrame, rules: Sequence[Rule], references: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """Offending keys per rule that has any, named after the rule and its position."""
    found = {}
    for position, rule in enumerate(rules):
        if rule.name == UNIQUE:
            keys = duplicate_keys(df, rule.column, missing_repeats=rule.missing_repeats)
        elif rule.name == FOREIGN_KEY:
            reference = references[rule.reference_dataset]
            keys = orphan_keys(df, rule.column, reference, rule.reference_column)
        else:
            continue
        found[_set_name(rule, position)] = keys.select(
            F.col(f"`{rule.column}`").alias(f"{RESERVED}key_{position}")
        )
    return found


def _look_up_all(
    df: DataFrame, rules: Sequence[Rule], key_sets: Mapping[str, DataFrame]
) -> DataFrame:
    names = [name for name in df.columns if not name.startswith(DATE_TEXT)]
    check_reserved(df.select(*[F.col(f"`{name}`") for name in names]))
    annotated = df
    broken: list[Column] = []
    for position, rule in enumerate(rules):
        if rule.name not in (UNIQUE, FOREIGN_KEY):
            broken.append(row_violation(df, rule))
            continue
        offending, found = F.col(f"{RESERVED}key_{position}"), f"{RESERVED}found_{position}"
        keys = key_sets[_set_name(rule, position)].withColumn(found, F.lit(True))
        key = key_column(df, rule.column)
        null_safe = rule.name == UNIQUE and rule.missing_repeats
        same = key.eqNullSafe(offending) if null_safe else key == offending
        annotated = annotated.join(keys, same, "left")
        hit = F.col(found).isNotNull()
        broken.append(hit if rule.name == UNIQUE else hit | key.isNull())
    # Joined arrays stay in generated code, which array_compact and its lambda would leave.
    none = F.array().cast("array<int>")
    issues = F.concat(
        none, *[F.when(hit, F.array(F.lit(i))).otherwise(none) for i, hit in enumerate(broken)]
    )
    return annotated.select(*[F.col(f"`{name}`") for name in names], issues.alias(ISSUES))


def split_once(annotated: DataFrame, stage: Stage, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows without issues, rows with issues and their ``ISSUES``), annotated but once where that is dear.

    Where the key sets are broadcast, annotating twice costs a scan, and only the rows with issues,
    which feed several outputs, are staged. Where rows are shuffled for it, all are staged, in two folders.
    """
    if not joins_by_shuffle(annotated):
        faulty = stage.table(annotated.filter(F.size(ISSUES) > 0), f"faulty_{name}")
        return annotated.filter(F.size(ISSUES) == 0), faulty
    marked = annotated.withColumn(FAULTY, F.size(ISSUES) > 0)
    written = stage.table(marked, f"marked_{name}", partition_by=FAULTY)
    return written.filter(~F.col(FAULTY)).drop(FAULTY), written.filter(FAULTY).drop(FAULTY)


def _set_name(rule: Rule, position: int) -> str:
    return f"{rule.name}_{position}"
