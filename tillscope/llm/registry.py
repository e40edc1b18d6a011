"""Queries of this package and their SQL, where SQL can express them."""

from . import queries_chats as chats
from . import queries_duplicates as duplicates
from . import queries_filters as filters
from . import queries_models as models
from . import queries_search as search
from . import queries_tokens as tokens
from . import queries_trie as trie
from . import queries_vectors as vectors

QUERIES = {
    "op1_bpe_encoding": tokens.op1_bpe_encoding,
    "op2_chat_formatting": chats.op2_chat_formatting,
    "op3_decontamination": filters.op3_decontamination,
    "op4_secret_scan": filters.op4_secret_scan,
    "op5_nearest_neighbours": vectors.op5_nearest_neighbours,
    "op6_token_files": tokens.op6_token_files,
    "op7_simhash": duplicates.op7_simhash,
    "op8_line_dedup": duplicates.op8_line_dedup,
    "op9_quality": models.op9_quality,
    "op10_language": models.op10_language,
    "op11_lexical_search": search.op11_lexical_search,
    "op12_fingerprints": duplicates.op12_fingerprints,
    "op13_prefix_trie": trie.op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op2_chat_formatting": chats.OP2_SQL,
    "op3_decontamination": filters.OP3_SQL,
    "op8_line_dedup": duplicates.OP8_SQL,
    "op11_lexical_search": search.OP11_SQL,
    "op13_prefix_trie": trie.OP13_SQL,
}
