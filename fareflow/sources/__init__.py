from fareflow.sources.raw import RAW_SCHEMAS, RAW_TABLES, read_raw
from fareflow.sources.adapter import ADAPTER_SQL, TPCH_TABLES, raw_tables_from_testdata

__all__ = ["RAW_SCHEMAS", "RAW_TABLES", "read_raw", "ADAPTER_SQL", "TPCH_TABLES",
           "raw_tables_from_testdata"]
