"""Token operators against the library itself."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfline.llm import packing, token_counts, wavelet
from shelfline.llm.tokens import Encoder
from tests.llm.helpers import ODD_TEXTS, prose, tokenizer_path

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "extra", i) for i, t in enumerate([*ODD_TEXTS, prose(1, 5000), prose(2, 900)])]
    rows += [(None, "no key", "x", 1), (3, "again", "x", 1), (3, "again", "x", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, key string, n_tokens bigint")


def ids_of(path, texts):
    t = Tokenizer.from_file(path)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("name", FILES)
def test_encoder_equals_the_library(name):
    path = tokenizer_path(name)
    texts = [*ODD_TEXTS, *(prose(s, 200) for s in range(20)), "a\n b", "x \ny", "A's 'S", "᠎ a᠎ b", "\x85 a \x1c b\x1d"]
    ids, ends = Encoder(path).encode(pa.array(texts, pa.string()))
    want = ids_of(path, texts)
    assert [p.tolist() for p in np.split(ids, ends[:-1])] == want
    assert Encoder(path).count(pa.array(texts, pa.string())).tolist() == [len(w) for w in want]


def test_encoder_forgets_without_change(monkeypatch):
    import shelfline.llm.tokens as tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    path, coder = tokenizer_path(FILES[0]), Encoder(tokenizer_path(FILES[0]))
    for text in [prose(s, 60) for s in range(5)]:
        assert coder.encode(pa.array([text]))[0].tolist() == ids_of(path, [text])[0]


@pytest.mark.parametrize(("name", "merged"), [(FILES[0], {"Word", "Ġword", "ĠWord", "ĠWORD"}), (FILES[1], {"word", "Ã©tÃ©"})])
def test_a_word_is_merged_once(name, merged):
    path, coder = tokenizer_path(name), Encoder(tokenizer_path(name))
    texts, model, seen = ["Word word, Word. WORD", "Word! word?! word"], coder.model, []
    if name == FILES[1]:
        texts += ["été Été. ÉTÉ"]

    class Model:
        def tokenize(self, word):
            seen.append(word)
            return model.tokenize(word)

    coder.model = Model()
    ids, ends = coder.encode(pa.array(texts))
    assert [p.tolist() for p in np.split(ids, ends[:-1])] == ids_of(path, texts)
    assert sorted(seen) == sorted(merged)


def test_words_and_marks_equal_the_library():
    marks = ".,;:!?%&*$#()"
    texts = [f"{word}{m} {m}{word} {word}{m}{m[::-1]}{word}" for word in ["a", "B's", "Àß", "×", "ÿ÷", "e\u0301", "x1", "<|endoftext|>"] for m in [*marks, marks, marks + "-"]]
    for name in FILES:
        ids, ends = Encoder(tokenizer_path(name)).encode(pa.array(texts))
        assert [p.tolist() for p in np.split(ids, ends[:-1])] == ids_of(tokenizer_path(name), texts)


def test_token_counts(docs):
    path = tokenizer_path(FILES[0])
    got = sorted(tuple(r) for r in token_counts.token_counts(docs.where("doc_id is not null"), path, batch_bytes=1000).collect())
    rows = docs.where("doc_id is not null").collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(i)) for r, i in zip(rows, ids_of(path, [r.text for r in rows]), strict=True)]
    assert got == sorted((*w, w[2] > 512) for w in want)
    assert token_counts.token_counts(docs.where("doc_id is null"), path).first().n_tokens == len(ids_of(path, ["no key"])[0])
    assert token_counts.token_counts(docs.limit(0), path).count() == 0


def test_packing(docs):
    path = tokenizer_path(FILES[0])
    got = packing.pack_documents(docs.where("doc_id is null or doc_id <> 3"), path, end_id=2).toPandas()
    rows = docs.where("doc_id is not null and doc_id <> 3").collect()
    for r, ids in zip(rows, ids_of(path, [r.text for r in rows]), strict=True):
        ids, at = np.array([*ids, 2], "<u4"), 0
        own = got[got.doc_id == r.doc_id].sort_values("piece")
        assert own.piece.tolist() == list(range(-(-len(ids) // 1024)))
        assert own.length.tolist()[1:] == [1024] * (len(own) - 1)
        for p in own.itertuples():
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum().tolist()[:-1]] and part.length.sum() <= 1024
    assert packing.pack_documents(docs.limit(0), path, end_id=2).count() == 0


def test_repeated_rows_are_packed_each(docs):
    got = packing.pack_documents(docs.where("doc_id = 3"), tokenizer_path(FILES[0]), end_id=2)
    assert got.count() == 3 and got.select("sequence_id", "offset").distinct().count() == 3


def test_best_fit_keeps_every_capacity():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 71, 3000)
    for score in ("norm", "dot"):
        at = packing.best_fit(lengths, 100, most_documents=4, most_cost=5000.0, score=score)
        pieces = np.bincount(at)
        assert (np.bincount(at, lengths) <= 100).all() and (np.bincount(at, lengths * lengths) <= 5000).all()
        assert pieces.max() <= 4 and pieces.min() >= 1
    lengths = rng.integers(1, 101, 3000)
    at = packing.best_fit(lengths, 100)
    assert at.max() + 1 <= 1.03 * -(-lengths.sum() // 100)
    with pytest.raises(ValueError, match="capacity"):
        packing.best_fit(np.array([101]), 100)


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 511, 512, 513, 5000])
def test_wavelet_matrix(size):
    rng = np.random.default_rng(size)
    values = rng.integers(0, 40, size)
    values[: size // 3] = 7
    matrix, keys, ends = wavelet.from_file(wavelet.to_file(values, 6, [None, 5], [size // 2, size - size // 2]))
    assert keys == [None, 5] and ends.tolist() == [size // 2, size]
    assert (matrix.decode() == values).all() and (matrix.access(np.arange(size)) == values).all()
    for v in range(0, 64, 7):
        assert matrix.count(v) == (values == v).sum() and matrix.count(v, size // 2) == (values[: size // 2] == v).sum()
        assert (matrix.locate(v) == np.flatnonzero(values == v)).all()


def test_wavelet_shards(docs, spark):
    path = tokenizer_path(FILES[1])
    rows = docs.where("doc_id is not null and doc_id <> 3").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in wavelet.token_shards(docs.where("doc_id is not null and doc_id <> 3").repartition(3), path, 1, shard=500).collect()}
    at = 0
    for r, ids in zip(rows, ids_of(path, [r.text for r in rows]), strict=True):
        data = np.array([*ids, 1], "<u4")
        assert tuple(got[r.doc_id]) == (r.doc_id, at, len(data), zlib.crc32(data.tobytes()))
        at += len(data)
    assert wavelet.token_shards(docs.where("doc_id is null or doc_id = 3"), path, 1).count() == 4
    assert wavelet.token_shards(docs.limit(0), path, 1).count() == 0


def test_damaged_shard():
    data = wavelet.to_file(np.arange(9), 4, [1], [9])
    with pytest.raises(ValueError, match="not a wavelet"):
        wavelet.from_file(b"no" + data)
