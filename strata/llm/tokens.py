"""Token ids of texts and the cutting of overlong documents.

Ids are those of a public tokenizer file, with one closing id per document.
Splitting into words and merging bytes goes through the library's fast
encoder for the same vocabulary when its rank file stands beside the JSON
file; ids are the same (tested against the JSON file's own library).
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CAPACITY = 2048
END_ID = 0


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """text -> ids, for the tokenizer file at ``path``."""
    ranks = os.path.splitext(path)[0] + ".tiktoken"
    if os.path.exists(ranks):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        return lambda text: np.array(fast.encode_ordinary(text), dtype=np.uint32)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    return lambda text: np.array(plain.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def document_ids(text: str | None, path: str, end_id: int = END_ID) -> np.ndarray:
    """Ids of a text (null: none) and the closing id."""
    ids = encoder(path)(text) if text else np.zeros(0, dtype=np.uint32)
    return np.append(ids, np.uint32(end_id)).astype("<u4")


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first."""
    first = (n - 1) % capacity + 1
    bounds = [0, *range(first, n + 1, capacity)]
    return list(zip(bounds[:-1], np.diff(bounds).tolist()))


def pieces(batch: pa.RecordBatch, path: str, capacity: int, end_id: int) -> Iterator[tuple[int | None, int, int, np.ndarray]]:
    """(doc_id, piece, start, ids) of the rows of a (doc_id, text) batch."""
    ids, texts = batch.column(0), batch.column(1)
    for i in range(batch.num_rows):
        tokens = document_ids(texts[i].as_py(), path, end_id)
        for k, (start, length) in enumerate(cuts(len(tokens), capacity)):
            yield ids[i].as_py(), k, start, tokens[start : start + length]
