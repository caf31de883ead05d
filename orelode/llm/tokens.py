"""Token counts of texts with a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from orelode.plans.runtime import spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published splitting pattern of this vocabulary; a fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer texts are encoded piece by piece, cut where the pattern splits, so no count changes.
PIECE = 100_000
BORDER = re.compile(r"\S(?=\s\S)|[A-Za-z\u4e00-\u9fff](?=[0-9!-&(-/:-@\uff0c\u3002])")


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _border(text: str, at: int) -> int:
    """The first place from ``at`` on where the splitting pattern surely splits: before a single
    blank, or between a letter and a digit or sign; else the end."""
    found = BORDER.search(text, at)
    return found.start() + 1 if found else len(text)


def count(text: str | None, path: str = VOCABULARY) -> int:
    """Number of tokens; 0 for null and empty texts."""
    if not text:
        return 0
    enc, n, at = encoder(path), 0, 0
    while len(text) - at > PIECE:
        end = _border(text, at + PIECE)
        n += len(enc.encode_ordinary(text[at:end]))
        at = end
    return n + len(enc.encode_ordinary(text[at:]))


def with_counts(docs: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``keep`` and ``n_tokens`` of every document; the text itself does not travel on."""
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", n_tokens int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                counts = [count(t.as_py(), path) for t in part.column(text)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(counts, pa.int32())], names=[*keep, "n_tokens"])

    return spread(docs.select(*keep, text)).mapInArrow(run, schema)
