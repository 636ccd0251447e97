"""Token counts, token files and byte-level BPE against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from delaylens.llm import byte_bpe, common, pieces, token_count, token_ids

random.seed(5)
TEXTS = [None, "", " ", "   ", "a", " a ", "a  b", "a   b", "a \n b\t\tc", "\n\n", "don't CAN'T 've", "<|endoftext|> x <|startoftext|>",
         "x<|endoftext|>", "é" * 500, "e\u0301 \u0301a", "\u3000a\u00a0b\x1c c\x85d", "日本語 テキスト", "🙂 🙂🙂", "ab" * 800, "a" * 1500,
         "ΑΣ σας İı", "1234567890 " * 400] + ["".join(random.choice(" \n\tab1'é.A") for _ in range(random.randint(0, 40))) for _ in range(400)]


def docs(spark, texts=TEXTS):
    """With columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string, shard int")


def test_counts_match_the_library(spark):
    path = P.path("word_bpe_49k.json")
    encode = Tokenizer.from_file(path).encode
    got = {r["doc_id"]: r for r in token_count.token_counts(docs(spark), path, limit=100).collect()}
    for i, t in enumerate(TEXTS):
        n = len(encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((t or "").encode()), n > 100), repr(t)


def test_counts_of_a_sentencepiece_model(spark):
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r["doc_id"]: r["n_tokens"] for r in token_count.token_counts(docs(spark), path).collect()}
    assert got == {i: len(model.encode(t or "")) for i, t in enumerate(TEXTS)}


def test_long_text_is_cut_into_slices():
    batch = pa.RecordBatch.from_pydict({"t": ["a b " * 100, None, "c" * 50, "d"]})
    parts = [p.num_rows for p in common.byte_slices(batch, 0, limit=64)]
    assert sum(parts) == 4 and len(parts) > 1
    assert not list(common.byte_slices(batch.slice(0, 0), 0))


def test_count_of_a_long_text_goes_in_parts(monkeypatch):
    import delaylens.llm.shingles as S
    path = P.path("word_bpe_49k.json")
    own, given = token_count.WordCounter(path), []
    words = own.words
    monkeypatch.setattr(own, "words", lambda w: given.append(len(w)) or words(w))
    monkeypatch.setattr(token_count, "SLICE_BYTES", 10_000)
    monkeypatch.setattr(S, "PART", 5000)
    texts = ["short one", " ".join(map(str, range(10_000))), "", "é\t\u3000x " * 3000, "z" * 12_000]
    encode = Tokenizer.from_file(path).encode
    assert own.texts(pa.array(texts)).tolist() == [len(encode(t, add_special_tokens=False).ids) for t in texts]
    assert max(given) < 2500 and own.texts(pa.array([], pa.string())).tolist() == []


def test_pieces_join_to_the_texts():
    texts = [t or "" for t in TEXTS]
    found, index, stops = pieces.cut(pa.array(texts))
    start = 0
    for t, stop in zip(texts, stops):
        assert "".join(found[k] for k in index[start:stop]) == t
        start = stop


def test_memo_stays_bounded():
    memo = common.Memo(10)
    for k in range(1000):
        memo.put(k, k)
        memo.get(0)
    assert memo.get(0) == 0 and len(memo.young) + len(memo.old) <= 11


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5], [3, 3, 1000, 10 ** 12], list(range(3000)), sorted(random.choices(range(10 ** 6), k=2000))])
def test_elias_fano(values):
    code = token_ids.EliasFano.from_bytes(token_ids.EliasFano.encode(np.array(values, np.int64)).to_bytes())
    assert [code.select(i) for i in range(len(values))] == values
    for a, b in [(0, len(values)), (len(values) // 3, len(values) // 2), (len(values), len(values))]:
        assert code.slice(a, b).tolist() == values[a:b]
    if len(values) > 1000:
        assert len(code.low) + len(code.high) <= len(values) * (3 + code.low_bits) / 8 + 16


def test_elias_fano_over_superblocks():
    """Several superblocks, stretches without ones, and a directory under a quarter of the code."""
    rnd = np.random.default_rng(3)
    gaps = rnd.integers(0, 400, 2_500_000)
    gaps[[10, 1_200_000]] = 60_000_000_000
    values = np.cumsum(gaps)
    made = token_ids.EliasFano.encode(values)
    code = token_ids.EliasFano.from_bytes(made.to_bytes())
    assert len(code.far) > 3 and 4 * code.directory_bytes() < len(code.low) + len(code.high)
    for i in [0, 9, 10, 11, 1_199_999, 1_200_000, 1_200_001, 2_499_999, *rnd.integers(0, 2_500_000, 300).tolist()]:
        assert code.select(i) == values[i]
    for a, b in [(0, 50), (5, 15), (1_199_990, 1_200_010), (777_777, 900_001), (2_499_000, 2_500_000)]:
        assert (code.slice(a, b) == values[a:b]).all()


def test_remembered_pieces_are_weighed(monkeypatch):
    """Long pieces fill the memo by bytes; what is encoded stays right."""
    monkeypatch.setattr(token_ids, "KEPT_BYTES", 50_000)
    path = P.path("byte_bpe_50k.json")
    own, encode = token_ids.PieceIds(path), Tokenizer.from_file(path).encode
    for k in range(6):
        texts = [" " * (3000 * k + j) + f"word{k} end" for j in range(8)] + ["", "short"]
        ids, n = own.texts(pa.array(texts), 0)
        assert own.held <= 50_000
        assert ids.tolist() == [x for t in texts for x in [*encode(t, add_special_tokens=False).ids, 0]]


@pytest.mark.parametrize("shards", [1, 5])
def test_token_files(spark, shards):
    path = P.path("byte_bpe_50k.json")
    encode = Tokenizer.from_file(path).encode
    rows = [(i - 7, t) for i, t in enumerate(TEXTS)] + [(None, "no name"), (3, "again")]
    manifest = token_ids.write_token_ids(spark.createDataFrame(rows, "doc_id long, text string"), path, shards=shards)
    got = token_ids.read_token_ids(manifest).orderBy("start").collect()
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*encode(t or "", add_special_tokens=False).ids, 0])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
        assert any(len(x) == r["n_tokens"] and zlib.crc32(np.array(x, "<u4").tobytes()) == r["ids_crc32"] for x in ids[r["doc_id"]])
    shard = token_ids.Shard(manifest.orderBy("shard").first()["path"])
    runs = [(d, n) for docs_, ends, _ in shard.runs() for d, n in zip(docs_, np.diff(ends, prepend=0))]
    for k in range(0, shard.n, 37):
        assert len(shard.document(k)) == runs[k][1]


def test_token_files_of_nothing(spark):
    manifest = token_ids.write_token_ids(docs(spark, []), P.path("byte_bpe_50k.json"))
    assert manifest.count() == 0 and token_ids.read_token_ids(manifest).count() == 0


def test_cut_off_file_is_refused(spark, tmp_path):
    manifest = token_ids.write_token_ids(docs(spark), P.path("byte_bpe_50k.json"), shards=1)
    data = open(manifest.first()["path"].removeprefix("file:"), "rb").read()
    (tmp_path / "short.ids").write_bytes(data[:100] + data[104:])
    with pytest.raises(ValueError):
        token_ids.Shard(str(tmp_path / "short.ids"))


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_bpe_matches_tiktoken(spark, name):
    path = P.path(name)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    got = {r["doc_id"]: r for r in byte_bpe.round_trip(docs(spark), path, P.PATTERN).collect()}
    for i, t in enumerate(TEXTS):
        ids = own.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids), repr(t)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_encode_decode(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(docs(spark), path, P.PATTERN)
    back = {r["doc_id"]: bytes(r["content"]) for r in byte_bpe.decode(encoded, path, P.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(TEXTS)}
    assert byte_bpe.round_trip(docs(spark, []), path, P.PATTERN).count() == 0


def test_bpe_bytes_come_from_the_ids(monkeypatch):
    """Faulty ids show in the decoded bytes: the fault is put into what the encoder emits."""
    own = byte_bpe.Bpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    texts = pa.array(["some words, then others"])
    assert [content for *_, content in own.texts(texts)] == [b"some words, then others"]
    own._begin()
    words = own.words

    def faulty(given):
        pool = words(given)
        pool.data = pool.data[::-1].copy()
        return pool

    monkeypatch.setattr(own, "words", faulty)
    [(ids, _, content)] = own.texts(texts)
    form = {rank: token for token, rank in own.ranks.items()}
    assert content == b"".join(form[i] for i in ids.tolist()) != b"some words, then others"


def test_bpe_unknown_id_raises(spark):
    bad = spark.createDataFrame([(1, [0, 10 ** 6])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="vocabulary"):
        byte_bpe.decode(bad, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()


def test_what_is_remembered_is_bounded_by_bytes(monkeypatch):
    """Texts that stand as one piece do not pile up."""
    monkeypatch.setattr(byte_bpe, "KEPT_BYTES", 100_000)
    own = byte_bpe.Bpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    for k in range(40):
        texts = [f"if x{k}_{j}:\n    return {j}   # {k}\n" * 5 for j in range(20)]
        got = list(own.texts(pa.array(texts)))
        assert [c.decode() for _, _, c in got] == texts
        assert own.ids.data.nbytes + own.forms.data.nbytes + 4 * own.named <= 100_000
