"""Sizes of texts in tokens of a public byte-level tokenizer."""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.common import scan_arrow

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: the vocabulary's own way to cut text before merging
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: sizes of blank-delimited pieces a worker remembers
REMEMBERED = 1_000_000


@lru_cache(maxsize=2)
def read_ranks(path: str) -> bytes:
    """The vocabulary file; a missing one is an error, on the driver, so results do not depend on the disk of an executor."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def encoding(ranks: bytes):
    import tiktoken

    parsed = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("bytes", pat_str=PRE_SPLIT, mergeable_ranks=parsed, special_tokens={})


class TokenCounter:
    """Exact token counts, faster than encoding the text.

    No token spans a blank that follows a non-blank and precedes one, and the
    blank belongs to what follows, so the text's size is the sum over its
    blank-delimited pieces, whose sizes are remembered.  Runs of three or more
    blanks merge among themselves; a text that has them is encoded as it is.
    """

    def __init__(self, ranks: bytes):
        self.encode, self.sizes = encoding(ranks).encode_ordinary, {}

    def __call__(self, text: str) -> int:
        if "   " in text:
            return len(self.encode(text))
        first, *rest = text.split(" ")
        sizes = self.sizes
        if len(sizes) > REMEMBERED:
            sizes.clear()
        head = len(self.encode(first)) if first else 0
        try:
            return head + sum(map(sizes.__getitem__, rest))
        except KeyError:
            encode = self.encode
            for piece in set(rest):
                if piece not in sizes:
                    sizes[piece] = len(encode(" " + piece))
            return head + sum(map(sizes.__getitem__, rest))


def token_sizes(rows: DataFrame, keys: list[str], text: str = "text", ranks: str = DEFAULT_RANKS, size: str = "n_tokens") -> DataFrame:
    """``keys`` and the tokens of each row's text (0 for a null or empty text); the text is not carried on.

    The vocabulary file (under 1 MB) is read here and sent with the job.
    """
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    def count(batches):
        counter = TokenCounter(shared.value)
        for batch in batches:
            found = [counter(t) if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names=[*batch.schema.names[:-1], size])

    types = dict(rows.dtypes)
    plain = rows.select(*keys, F.col(text).alias("_text"))
    return scan_arrow(plain, count, ", ".join(f"`{k}` {types[k]}" for k in keys) + f", {size} bigint")
