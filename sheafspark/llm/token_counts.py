"""Token counts of whole texts, without keeping the tokens."""

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.llm.arrow_text import SLICE_BYTES, byte_column, each, row_slices, white_space_blocks

#: Distinct words whose counts a task keeps; beyond that it starts over.
KEPT_WORDS = 500_000


def drops_white_space(path: str) -> bool:
    """Whether ASCII white space is a safe cut: the tokenizer never looks across it and gives no token for it."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(" \t\n\v\f\r") for t in spec["added_tokens"]):
        return False
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [spec.get("pre_tokenizer") or {}])
    first = steps[0]
    return (
        first.get("type") == "Split"
        and first.get("behavior") == "Removed"
        and first.get("invert") is True
        and "\\s" in first["pattern"].get("Regex", "")
        and spec.get("post_processor") is None
    )


class LengthEncoder:
    """Counts tokens with the tokenizer's own library, in batches of about equal bytes."""

    def __init__(self, path: str, batch_bytes: int = SLICE_BYTES):
        self.batch_bytes = batch_bytes
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self._encode = lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
        self._by_word = {} if drops_white_space(path) else None

    def _batches(self, texts: list[bytes]) -> Iterator[int]:
        batch, size = [], 0
        for text in texts:
            batch.append(text.decode())
            size += len(text)
            if size >= self.batch_bytes:
                yield from self._encode(batch)
                batch, size = [], 0
        if batch:
            yield from self._encode(batch)

    def _count_words(self, text: bytes) -> int:
        known, total = self._by_word, 0
        for block in white_space_blocks(text):
            words = block.split()
            try:
                total += sum(map(known.__getitem__, words))
                continue
            except KeyError:
                pass
            if len(known) > KEPT_WORDS:
                known.clear()
            new = list(dict.fromkeys(w for w in words if w not in known))
            known.update(zip(new, self._batches(new), strict=True))
            total += sum(map(known.__getitem__, words))
        return total

    def lengths(self, column: pa.Array) -> pa.Array:
        column = byte_column(column)
        counts = np.zeros(len(column), np.int64)
        for start, stop in row_slices(column, self.batch_bytes):
            texts = column.slice(start, stop - start).to_pylist()
            if self._by_word is None:
                counts[start:stop] = list(self._batches(texts))
                continue
            if len(texts) > 1:  # one look for the new words of the whole slice
                self._count_words(b"\n".join(texts))
            counts[start:stop] = [self._count_words(t) for t in texts]
        return pa.array(counts)


def n_tokens(text: Column, tokenizer: str) -> Column:
    """The number of tokens of each text; see :func:`token_counts`."""

    @F.arrow_udf("long")
    def lengths(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = LengthEncoder(tokenizer)
        for column in each(columns):
            yield encoder.lengths(column)

    return lengths(text)


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """Adds n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) for every whole text.

    ``tokenizer`` names a file that every executor has: ``.json`` for the tokenizers library, ``.model`` for
    sentencepiece. No begin, end or added special tokens; special strings inside a text count as the library has them.
    Only lengths leave the Arrow function. Where white space is a safe cut, long texts are cut there and each distinct
    word goes through the library once for a while; otherwise whole texts do, in batches of about equal bytes.

    Null and empty texts have 0 bytes and 0 tokens. An empty table gives an empty table. Repeated rows are counted
    each. Columns of the same names are replaced, other columns stay.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")])
    counted = docs.select(row.alias("row"), F.col(f"`{text}`").alias("text")).select(
        "row",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        n_tokens(F.col("text"), tokenizer).alias("n_tokens"),
    )
    return counted.select("row.*", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
