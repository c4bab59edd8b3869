from .jsonl import archive_raw, read_records_json, split_rejects, write_records_json
from .payloads import payload_yield, shred_payloads
from .xml import parse_record, read_records_xml, record_text, write_records_xml

__all__ = [
    "archive_raw", "parse_record", "payload_yield", "read_records_json", "read_records_xml",
    "record_text", "shred_payloads", "split_rejects", "write_records_json", "write_records_xml",
]
