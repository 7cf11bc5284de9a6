from brindle.functions.hashing import HASH_BITS, PRIME, bucket_of, integer_hash, lane_numbers, seeded_hash
from brindle.functions.salting import register_salt_functions, row_salt
from brindle.functions.text import lines, tokens

__all__ = [
    "HASH_BITS",
    "PRIME",
    "bucket_of",
    "integer_hash",
    "lane_numbers",
    "lines",
    "register_salt_functions",
    "row_salt",
    "seeded_hash",
    "tokens",
]
