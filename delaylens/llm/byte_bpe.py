"""Byte-level BPE in DuckDB: recursive queries inside the tasks.

A rank file gives the vocabulary. Every two tokens whose bytes joined are a
token form a row (left, right, merged) of the merge table. The words of a
slice of texts (matches of the pattern; each distinct word once) become
token-position rows, one per byte. A recursive query joins neighbouring rows
with the merge table, contracts each word's leftmost pair of least rank and
repeats until no word has a pair left; rows in order of place are each word's
ids. Decoding takes ids alone: an ordered aggregation over the vocabulary's
bytes, once per piece when it is first met; its ids and the bytes they decode to
are remembered side by side. A text is the concatenation of its pieces.

Long words (over ``LONG`` bytes) take a second query that contracts all
non-overlapping occurrences of the least-ranked pair at once wherever that is
the same as one after the other: a merge is "early" if it forms a token that
some merge of lower rank uses, and early merges still go one by one.

Per task memory is bounded: slices of about 2 MB of text, words in runs of
``RUN_BYTES`` bytes and ``STEPS`` contractions per query (unfinished words go
on in the next query), and pieces of ``KEPT_BYTES`` bytes remembered per worker.

Nulls: a null text counts as empty and has no ids; a null or unknown id makes
``decode`` raise. Repeated rows give equal results, other columns are ignored,
an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import tempfile
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import byte_slices, give_back, small_batches, tidy
from delaylens.llm.pieces import Pool, cut
from delaylens.session import materialize

RUN_BYTES = 200_000
LONG = 256
STEPS = 64
KEPT_BYTES = 96 << 20
SLICE_BYTES = 2 << 20

#: one contraction per word and step: rows (w, p, t, n) hold a token t at place p of word w and the next token n
SHORT_WORDS = """
WITH RECURSIVE step AS (
  SELECT 0 AS it, w, p, t, lead(t) OVER (PARTITION BY w ORDER BY p) AS n FROM start
  UNION ALL
  SELECT it + 1, w, CASE WHEN p > spot THEN p - 1 ELSE p END, CASE WHEN p = spot THEN m ELSE t END,
         CASE WHEN p = spot THEN next_t WHEN p = spot - 1 THEN m ELSE n END
  FROM step JOIN (
    SELECT best.w, spot, m, s.n AS next_t
    FROM (SELECT w, min(g.m::BIGINT * 4294967296 + p) AS least, least & 4294967295 AS spot, least >> 32 AS m
          FROM step JOIN merges g ON g.l = t AND g.r = n GROUP BY w) best
    JOIN step s ON s.w = best.w AND s.p = spot + 1) USING (w)
  WHERE p <> spot + 1 AND it < {steps})
SELECT it, w, p, t FROM step JOIN (SELECT w, max(it) AS it FROM step GROUP BY w) USING (w, it)
"""

LONG_WORDS = """
WITH RECURSIVE step AS (
  SELECT 0 AS it, w, p, t FROM start
  UNION ALL
  SELECT it + 1, w, p, CASE WHEN taken THEN m ELSE t END
  FROM (SELECT *, coalesce(lag(taken) OVER (PARTITION BY w ORDER BY p), false) AS used
        FROM (SELECT *, meant AND row_number() OVER (PARTITION BY w, meant, island ORDER BY p) % 2 = 1 AS taken
              FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY p)
                              - row_number() OVER (PARTITION BY w, meant ORDER BY p) AS island
                    FROM (SELECT *, coalesce(k = least OR (m = least >> 32 AND NOT early), false) AS meant
                          FROM (SELECT *, min(k) OVER (PARTITION BY w) AS least
                                FROM (SELECT s.*, g.m, g.early, g.m::BIGINT * 4294967296 + s.p AS k
                                      FROM (SELECT *, lead(t) OVER (PARTITION BY w ORDER BY p) AS n FROM step) s
                                      LEFT JOIN merges g ON g.l = s.t AND g.r = s.n))
                          WHERE least IS NOT NULL AND it < {steps}))))
  WHERE NOT used)
SELECT it, w, p, t FROM step JOIN (SELECT w, max(it) AS it FROM step GROUP BY w) USING (w, it)
"""

#: the words' tokens in order of place
COLLECT = "SELECT w, t FROM tokens ORDER BY w, p"

DECODE = """
SELECT d, list(bytes ORDER BY p) AS parts, sum(octet_length(bytes)) AS size, count(*) AS n_ids, count(bytes) AS n_known
FROM ids LEFT JOIN ranks ON t = rank GROUP BY d ORDER BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, f)))}


class Bpe:
    """The vocabulary's tables in an in-process database, one per Python worker."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.words_of = regex.compile(pattern).findall
        self.ranks = ranks
        self.byte = np.full(256, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 1:
                self.byte[token[0]] = rank
        merges = [(ranks[t[:i]], ranks[t[i:]], m) for t, m in ranks.items() for i in range(1, len(t))
                  if t[:i] in ranks and t[i:] in ranks]
        early = {x for left, right, m in merges for x in (left, right) if x > m}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "150MB", "temp_directory": tempfile.gettempdir()})
        self.db.register("given", pa.table({"rank": pa.array(ranks.values(), pa.int32()), "bytes": pa.array(list(ranks), pa.binary())}))
        self.db.execute("CREATE TABLE ranks AS FROM given")
        left, right, made = (pa.array(c, pa.int32()) for c in zip(*merges)) if merges else (pa.array([], pa.int32()),) * 3
        self.db.register("given", pa.table({"l": left, "r": right, "m": made, "early": pa.array([m in early for *_, m in merges], pa.bool_())}))
        self.db.execute("CREATE TABLE merges AS FROM given")
        self.db.unregister("given")
        # decimals with a comma behind, by rank
        decimals = [b"%d," % r for r in range(max(ranks.values()) + 1)]
        self.decimals = Pool(np.uint8)
        self.decimals.add(np.frombuffer(b"".join(decimals), np.uint8), np.cumsum([*map(len, decimals)]))
        self._begin()

    def _begin(self) -> None:
        """Forget the pieces met so far."""
        self.code: dict[str, int] = {}
        self.ids, self.forms, self.named = Pool(np.int32), Pool(np.uint8), 0

    def _merge(self, words: list[bytes], query: str) -> None:
        """Leave the words' final tokens in table ``tokens`` (w, p, t)."""
        size = np.array([*map(len, words)])
        t = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        if (t < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        rows = pa.table({"w": pa.array(np.repeat(np.arange(len(words)), size), pa.int32()),
                         "p": pa.array(np.arange(len(t)) - np.repeat(np.cumsum(size) - size, size), pa.int32()), "t": t})
        # a word that is a token itself is not split
        whole = [self.ranks.get(w, -1) for w in words]
        hit = np.array([r >= 0 for r in whole])
        done = [pa.table({"w": pa.array(np.flatnonzero(hit), pa.int32()), "p": pa.array(np.zeros(hit.sum()), pa.int32()),
                          "t": pa.array([r for r in whole if r >= 0], pa.int32())})]
        rows = rows.filter(pa.array(~hit[rows["w"].to_numpy()]))
        while len(rows):
            steps = max(1, min(STEPS, 4_000_000 // len(rows)))
            self.db.register("start", rows)
            got = self.db.sql(query.format(steps=steps)).to_arrow_table()
            going = pc.equal(got["it"], steps)
            done.append(got.filter(pc.invert(going)).select(["w", "p", "t"]).cast(rows.schema))
            rows = got.filter(going).select(["w", "p", "t"]).cast(rows.schema)
        self.db.register("tokens", pa.concat_tables([done[0].cast(rows.schema), *done[1:]]))

    def words(self, words: list[str]) -> Pool:
        """Ids of each word."""
        coded = [w.encode("utf-8") for w in words]
        where, ids = [], Pool(np.int32)
        for long in (False, True):
            some = [k for k, b in enumerate(coded) if (len(b) > LONG) == long]
            runs = np.cumsum([len(coded[k]) for k in some]) // RUN_BYTES if some else []
            for _, run in itertools.groupby(zip(runs, some), key=lambda x: x[0]):
                run = [k for _, k in run]
                self._merge([coded[k] for k in run], LONG_WORDS if long else SHORT_WORDS)
                got = self.db.sql(COLLECT).to_arrow_table()
                ids.add(got["t"].to_numpy().astype(np.int32), np.cumsum(np.bincount(got["w"].to_numpy(), minlength=len(run))))
                where += run
        order = np.empty(len(words), np.int64)
        order[where] = np.arange(len(words))
        ids.data, ids.ends = ids.take(order)
        return ids

    def decoded(self, ids: pa.Array | np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that runs of ``sizes`` ids stand for, in one array, and the end of each run."""
        self.db.register("ids", pa.table({"d": np.repeat(np.arange(len(sizes)), sizes), "p": np.arange(len(ids)), "t": ids}))
        got = self.db.sql(DECODE).to_arrow_table()
        if not pc.all(pc.equal(got["n_ids"], got["n_known"]), min_count=0).as_py():
            raise ValueError("an id is not in the vocabulary")
        length = np.zeros(len(sizes), np.int64)
        length[got["d"].to_numpy()] = got["size"].to_numpy()
        flat = got["parts"].combine_chunks().flatten().cast(pa.large_binary()) if len(got) else pa.array([], pa.large_binary())
        ends = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
        data = np.frombuffer(flat.buffers()[2], np.uint8)[ends[0]:ends[-1]] if len(flat) and ends[-1] else np.zeros(0, np.uint8)
        return data, np.cumsum(length)

    def _codes(self, pieces: list[str]) -> np.ndarray:
        found = np.array([self.code.get(p, -1) for p in pieces], np.int64)
        at = np.flatnonzero(found < 0)
        new = [pieces[k] for k in at.tolist()]
        matches = [self.words_of(p) for p in new]
        number: dict[str, int] = {}
        flat = np.array([number.setdefault(w, len(number)) for ws in matches for w in ws], np.int64)
        last = np.cumsum([*map(len, matches)]) if matches else np.zeros(0, np.int64)
        data, stop = (self.words(list(number)) if number else Pool(np.int32)).take(flat)
        ends = np.concatenate([[0], stop])[last]
        self.ids.add(data, ends)
        if new:
            self.forms.add(*self.decoded(data, np.diff(ends, prepend=0)))
            self.named += sum(map(len, new))
        found[at] = np.arange(len(self.ids.ends) - len(new), len(self.ids.ends))
        self.code.update(zip(new, found[at].tolist()))
        return found

    def texts(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, bytes, bytes]]:
        """Per text: its ids, the ids as decimals joined by commas, the bytes the ids decode to."""
        pieces, index, stops = cut(texts)
        code = self._codes(pieces)[index] if pieces else index
        (ids, id_stop), (content, byte_stop) = self.ids.take(code), self.forms.take(code)
        if self.ids.data.nbytes + self.forms.data.nbytes + 4 * self.named + 100 * len(self.code) > KEPT_BYTES:
            self._begin()
        id_ends, byte_ends = (np.concatenate([[0], x])[stops] for x in (id_stop, byte_stop))
        a = c = 0
        for b, d in zip(id_ends.tolist(), byte_ends.tolist()):
            yield ids[a:b], self.decimals.take(ids[a:b])[0].tobytes()[:-1], content[c:d].tobytes()
            a, c = b, d


_LOADED: dict = {}


def bpe(path: str, pattern: str) -> Bpe:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Bpe(path, pattern)
    return _LOADED[path, pattern]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, ids`` (array of int)."""
    rows, kind = _rows(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                ids = [own for own, _, _ in bpe(path, pattern).texts(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return rows.mapInArrow(tidy(run), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: ``doc_id, content`` (the bytes the ids stand for; null ids arrays give no bytes)."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                sizes = pc.list_value_length(part.column(1)).to_numpy().astype(np.int64)
                flat = part.column(1).flatten()
                data, ends = bpe(path, pattern).decoded(flat, sizes)
                content = [data[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(content, pa.binary())], ["doc_id", "content"])

    return rows.mapInArrow(tidy(run), f"doc_id {kind}, content binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of
    the ids (decimals joined by commas) and of the bytes they decode to."""
    rows, kind = _rows(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                got = [(len(ids), hashlib.sha256(text).hexdigest(), hashlib.sha256(content).hexdigest())
                       for ids, text, content in bpe(path, pattern).texts(part.column(1))]
                n, ids, content = zip(*got)
                give_back()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(content)],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    with small_batches(docs.sparkSession):
        return materialize(rows.mapInArrow(tidy(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"),
                           "bpe-digests")
