from siftwork.sources.contract import EXPECTED_COLUMNS, check_columns, text_schema
from siftwork.sources.csv_files import (
    NULL_TOKENS,
    load_dataset,
    load_datasets,
    missing_to_null,
    scan_csv,
    scan_dataset_by_position,
)
from siftwork.sources.rules_document import load_rules_document
from siftwork.sources.sinks import read_table, restore_table, write_table
from siftwork.sources.zones import (
    ZONES,
    ZoneTable,
    list_zone,
    publish_to_zone,
    scan_zone,
    scan_zone_by_header,
    scan_zone_tables,
    zone_uri,
)

__all__ = [
    "EXPECTED_COLUMNS",
    "NULL_TOKENS",
    "ZONES",
    "ZoneTable",
    "check_columns",
    "list_zone",
    "load_dataset",
    "load_datasets",
    "load_rules_document",
    "missing_to_null",
    "publish_to_zone",
    "read_table",
    "restore_table",
    "scan_csv",
    "scan_dataset_by_position",
    "scan_zone",
    "scan_zone_by_header",
    "scan_zone_tables",
    "text_schema",
    "write_table",
    "zone_uri",
]
