"""Token counts of texts under a public byte-level BPE vocabulary."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framemill.session import spread

#: Folder of the vocabulary files and the vocabulary taken; both are parameters of every function here.
FOLDER = os.environ.get("FRAMEMILL_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"

#: Fixed value: the vocabulary's public pre-tokenizer pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(path: str):
    """The encoding at ``path``, loaded once per Python process."""
    import base64

    import tiktoken

    # kept on the library's module: functions arrive by value in every task, this module's globals would be fresh each time
    kept = tiktoken.__dict__.setdefault("_framemill_encodings", {})
    if path not in kept:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        kept[path] = tiktoken.Encoding("framemill", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return kept[path]


def _counting(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = pa.array([0 if t is None else len(encode(t)) for t in texts], pa.int64())
            columns = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), n], names=[*columns, "tokens"])

    return count


def counted(texts: DataFrame, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """Replaces ``text`` by ``tokens``, the length of the whole text in tokens; null texts have none. texts: doc_id, text and what is to be kept."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name != "text")
    return spread(texts, "doc_id").mapInArrow(_counting(f"{folder}/{vocabulary}"), schema + ", tokens bigint")


def source_key(column: str = "source"):
    """A source's name read loosely: letter case, outer blanks and '-' for '_' ignored; nothing named gives 'unknown'."""
    key = F.regexp_replace(F.lower(F.regexp_replace(column, r"^\s+|\s+$", "")), "-", "_")
    return F.when(key.isNull() | (key == ""), "unknown").otherwise(key)
