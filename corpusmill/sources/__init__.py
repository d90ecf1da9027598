from corpusmill.sources.records import (alpaca_records, messages_records, openorca_records,
                                        sharegpt_records)
from corpusmill.sources.scan import load_sources, scan_source

__all__ = ["alpaca_records", "load_sources", "messages_records", "openorca_records",
           "scan_source", "sharegpt_records"]
