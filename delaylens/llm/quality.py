"""Quality by compression: texts are compressed with a dictionary of good and
one of bad labelled text, and what that saves or costs becomes a score.

Two zstandard dictionaries are trained, one per label, on a bounded sample of
labelled texts (``SAMPLE`` texts per label, each at most ``MAX_TEXT`` bytes
long; a longer one is passed over in training, never in scoring). Lines that
several sampled texts share are left out, else a stock line that happens to
stand in a few bad texts would speak against every text that has it. A text's
feature is the normalised difference of compressed sizes,
``(with bad - with good) / (with bad + with good)``; a logistic curve fitted on
other labelled texts (another ``SAMPLE`` per label, weighted to the labels'
share) turns it into a probability. Only the text enters a score.

A text is compressed whole, in blocks of ``CHUNK`` bytes whose sizes are added
up: a dictionary helps at the start of a block only, so without blocks its
voice would fade in long texts. Nulls: a null text counts as empty; empty
texts have feature 0 and the score of the curve there. Labels that are null or
not 0 or 1 are passed over; without labelled texts of both kinds the fit
raises. Ties and repeated rows score alike. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from delaylens.llm.common import spare, tidy

SAMPLE = 1500
MAX_TEXT = 16 << 10
DICT_BYTES = 32 << 10
CHUNK = 2048
LEVEL = 3

_COMPRESSORS: dict = {}


def is_held_out(id_column: Column, folds: int = 4, out: int = 2) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == out


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def sizes(self, text: bytes) -> tuple[int, int]:
        """Compressed size with the good and with the bad dictionary."""
        if not self.good and not self.bad:
            return 0, 0
        key = hash((self.good, self.bad))
        if key not in _COMPRESSORS:
            made = [zstandard.ZstdCompressionDict(d) for d in (self.good, self.bad)]
            for d in made:
                d.precompute_compress(level=LEVEL)
            _COMPRESSORS[key] = [zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False,
                                                          write_dict_id=False) for d in made]
        good, bad = _COMPRESSORS[key]
        parts = [text[i:i + CHUNK] for i in range(0, len(text), CHUNK)]
        return sum(len(good.compress(p)) for p in parts), sum(len(bad.compress(p)) for p in parts)

    def feature(self, text: bytes) -> float:
        good, bad = self.sizes(text)
        return (bad - good) / max(1, bad + good)

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * features + self.offset, -40, 40)))


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Weighted logistic regression of y on one feature, by Newton steps."""
    scale = float(np.std(x)) or 1.0
    design, beta = np.stack([x / scale, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - ridge * beta
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2), slope)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE) -> Model:
    """Train on labelled rows that are not held out. The sample is bounded:
    the ``2 * sample`` labelled ids per label that come first by a hash; of a text
    over ``MAX_TEXT`` characters one block at a place told by the hash. Without texts
    of both labels every text scores the labels' share (0.5 without labels)."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out(F.col("id")))
    share = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.xxhash64("id")
    chosen = [known.where(F.col("label") == k).orderBy(place, "id").limit(2 * sample) for k in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))      # at most 4 * sample rows
    spot = (1 + F.pmod(F.xxhash64(id_col, F.lit(1)), F.greatest(F.length(text_col) - MAX_TEXT, F.lit(1)))).cast("int")
    rows = (docs.where(F.octet_length(text_col) > 0)
            .select(F.col(id_col).alias("id"), F.substring(F.col(text_col), spot, F.lit(MAX_TEXT)).alias("text"))
            .join(ids, "id").orderBy(place, "id", F.xxhash64("text")).limit(4 * sample).collect())
    texts = {k: [r["text"].encode("utf-8") for r in rows if r["label"] == k] for k in (0, 1)}
    if not texts[0] or not texts[1]:
        of = share.get(1, 0) / sum(share.values()) if share else 0.5
        return Model(b"", b"", 0.0, float(np.log(max(of, 1e-9) / max(1 - of, 1e-9))))
    half = {k: max(1, len(t) // 2) for k, t in texts.items()}
    seen = Counter(line for k in texts for t in texts[k][:half[k]] for line in set(t.split(b"\n")))
    own = {k: [b"\n".join(x for x in t.split(b"\n") if seen[x] == 1) for t in texts[k][:half[k]]] for k in (0, 1)}
    dicts = {k: _dictionary(own[k]) for k in (0, 1)}
    raw = Model(dicts[1], dicts[0], 1.0, 0.0)
    tune = {k: np.array([raw.feature(t) for t in texts[k][half[k]:] or texts[k]]) for k in (0, 1)}
    x = np.concatenate([tune[0], tune[1]])
    y = np.concatenate([np.zeros(len(tune[0])), np.ones(len(tune[1]))])
    total = share[0] + share[1]
    weight = np.where(y == 1, share[1] / total / max(1, len(tune[1])), share[0] / total / max(1, len(tune[0]))) * len(x)
    slope, offset = _fit_curve(x, y, weight)
    return Model(dicts[1], dicts[0], slope, offset)


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; too few samples to train on serve as a raw one."""
    if not texts:
        raise ValueError("no labelled texts of one kind")
    parts = [t[i:i + CHUNK] for t in texts for i in range(0, len(t), CHUNK)] or [b" "]
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, parts)) // 8)), parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICT_BYTES:]


def with_scores(docs: DataFrame, model: Model, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``name`` (0 to 1, higher: better); no shuffle."""
    if name in docs.columns:
        raise ValueError(f"the table has a column {name!r} already")
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    at = docs.columns.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            x = np.array([model.feature((t.as_py() or "").encode("utf-8")) for t in texts], np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], [*batch.schema.names, name])

    return docs.mapInArrow(tidy(score), schema)


def quality(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return (with_scores(rows, model, "score")
            .select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def drop_rejected(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, columns as they are."""
    [name] = spare(docs, "quality_score")
    return with_scores(docs, model, name, text_col).where(F.col(name) >= threshold).drop(name)
