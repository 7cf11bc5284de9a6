from brindle.sources.files import read_json, read_text, read_whole_files, split_corrupt
from brindle.sources.inferred import InferredJson, field_types, infer_json
from brindle.sources.logs import parse_access_log, parse_visits, visit_rejects
from brindle.sources.tables import from_rows, people, read_table, use_database

__all__ = [
    "InferredJson",
    "field_types",
    "from_rows",
    "infer_json",
    "parse_access_log",
    "parse_visits",
    "people",
    "read_json",
    "read_table",
    "read_text",
    "read_whole_files",
    "split_corrupt",
    "use_database",
    "visit_rejects",
]
