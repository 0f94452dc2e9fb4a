"""Sources and sinks: the driver's parquet tables, CSV ingest, parquet/model/JSON sinks."""

from rebuy.sources.csv import coerce_transactions, read_transactions_csv
from rebuy.sources.sinks import read_feature_list, write_feature_list, write_parquet
from rebuy.sources.stage import drop_stage_tables, stage_table
from rebuy.sources.tables import load_table, transactions_from_tables

__all__ = [
    "coerce_transactions",
    "drop_stage_tables",
    "stage_table",
    "load_table",
    "read_feature_list",
    "read_transactions_csv",
    "transactions_from_tables",
    "write_feature_list",
    "write_parquet",
]
