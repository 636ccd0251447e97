"""Token counts of whole texts, batch-encoded inside Arrow functions that
return lengths only.

Word vocabularies (a ``.json`` whose pre-tokenizer drops white space) never
look across an ASCII blank: a text is split there, which is a safe boundary,
the distinct words of a slice are encoded as one batch by the library, and a
text's count is the sum over its words. Any other vocabulary (``.model``) gets
whole texts. Slices hold about ``SLICE_BYTES`` of text however long the single
texts are, and in word vocabularies a text longer than a slice is cut at blanks
too and its parts' counts are added, so work arrays and batches are balanced by
bytes, not rows. Whole texts (``.model``) cost memory with the longest text.

Counts of words seen before are kept per Python worker, ``KEPT_WORDS`` at
most. Nulls: a null text counts as empty (0 bytes, 0 tokens). Rows that repeat
are counted each; other columns are ignored; an empty table gives no rows.
Special strings inside a text are handled as the library's default does.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import Memo, byte_slices
from delaylens.llm.shingles import _parts

SLICE_BYTES = 4 << 20
KEPT_WORDS = 400_000

_LOADED: dict = {}


def load_tokenizer(path: str):
    """The library's tokenizer for a file, once per Python worker; one thread."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece
            _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer
            _LOADED[path] = Tokenizer.from_file(path)
            _LOADED[path].no_truncation()
            _LOADED[path].no_padding()
    return _LOADED[path]


class WordCounter:
    """Tokens per text from tokens per word."""

    def __init__(self, path: str):
        self.tokenizer, self.known = load_tokenizer(path), Memo(KEPT_WORDS)

    def words(self, words: list[str]) -> np.ndarray:
        counts = [self.known.get(w) for w in words]
        new = [w for w, n in zip(words, counts) if n is None]
        found = dict(zip(new, map(len, self.tokenizer.encode_batch_fast(new, add_special_tokens=False))))
        for w, n in found.items():
            if len(w) < 64:
                self.known.put(w, n)
        return np.fromiter((found[w] if n is None else n for w, n in zip(words, counts)), np.int64, len(words))

    def texts(self, texts: pa.Array) -> np.ndarray:
        long = pc.binary_length(texts).to_numpy() > SLICE_BYTES
        out = np.zeros(len(texts), np.int64)
        out[~long] = self._short(texts.filter(pa.array(~long)))
        for k in np.flatnonzero(long).tolist():
            out[k] = sum(int(self._short(pa.array([part.decode("utf-8")]))[0]) for part in _parts(texts[k].as_py().encode("utf-8")))
        return out

    def _short(self, texts: pa.Array) -> np.ndarray:
        parts = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        codes = pc.dictionary_encode(parts.flatten())
        per_word = self.words(codes.dictionary.to_pylist())
        sums = np.concatenate([[0], np.cumsum(per_word[codes.indices.to_numpy()])]) if len(codes) else np.zeros(1, np.int64)
        ends = np.cumsum(pc.list_value_length(parts).to_numpy())
        return sums[ends] - sums[np.concatenate([[0], ends[:-1]])]


class TextCounter:
    """Tokens per text, each text encoded whole."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)

    def texts(self, texts: pa.Array) -> np.ndarray:
        return np.array([len(x) for x in self.tokenizer.encode(texts.to_pylist(), num_threads=1)], np.int64)


_COUNTERS: dict = {}


def counter(path: str):
    if path not in _COUNTERS:
        _COUNTERS[path] = (TextCounter if path.endswith(".model") else WordCounter)(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                n = own.texts(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pc.binary_length(part.column(1)).cast(pa.int64()), pa.array(n)],
                    ["doc_id", "n_bytes", "n_tokens"])

    return (rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
