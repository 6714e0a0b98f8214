"""Rules documents in YAML."""

from __future__ import annotations

from typing import Any

import yaml
from pyspark.sql import SparkSession


def load_rules_document(spark: SparkSession, uri: str) -> dict[str, Any]:
    """Read one YAML rules document from any storage URI; its top level must be a mapping.

    Several documents under the URI are an error: which rules hold must not depend on luck.
    """
    texts = spark.read.text(uri, wholetext=True).take(2)
    if len(texts) > 1:
        raise ValueError(f"Several rules documents under {uri}; name one.")
    document = yaml.safe_load(texts[0].value) if texts else None
    if not isinstance(document, dict):
        raise ValueError("A rules document must hold a mapping at the top level.")
    return document
