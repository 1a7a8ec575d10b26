import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import token_files as T
from cartwheel.session import scratch_dir

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path(T.TOKENIZER)


@pytest.fixture(scope="module")
def tokenizer():
    return T.load_tokenizer(PATH)


def plain_report(rows, tokenizer):
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [T.END_ID], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def got(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 40), max_size=700), st.integers(0, 2 ** 20), st.integers(0, 24))
def test_elias_fano_round_trip(values, extra, shift):
    values = np.sort(np.array([v >> shift for v in values], np.uint64))
    data = T.elias_fano(values, int(values[-1]) + 1 + extra if len(values) else extra)
    found = T.EliasFano(b"abc" + data + b"tail", 3)
    assert found.end == 3 + len(data)
    assert (found.get(np.arange(len(values))) == values).all()
    ranks = np.random.default_rng(1).permutation(len(values))
    assert (found.get(ranks) == values[ranks]).all()


def test_elias_fano_is_small_and_takes_clustered_values():
    rng = np.random.default_rng(2)
    values = np.sort(np.concatenate([rng.integers(0, 1000, 50_000), rng.integers(10 ** 9, 10 ** 9 + 50, 5000), [2 ** 62]])).astype(np.uint64)
    data = T.elias_fano(values, 2 ** 62 + 1)
    assert (T.EliasFano(data).get(np.arange(len(values))) == values).all()
    spread = np.sort(rng.integers(0, 1 << 21, 10_000)).astype(np.uint64)
    assert len(T.elias_fano(spread, 1 << 21)) * 8 < 10_000 * (2 + 8 + 1.5)  # 2 + log2(u / n) bits a value and the samples


def test_words_alone_give_the_ids_of_whole_texts(tokenizer, spark):
    assert T.splits_at_space(tokenizer) and T.lowers_ascii(tokenizer)
    odd = ["", " ", "A.B.C., d!! it's IT'S 'tis ''", "Straße İstanbul J̌ J̌. ΑΣ Σ.", "x　y z 1２3 9,000.50", "a\x00b\x1cc\x85d\x0be",
           "<|endoftext|> <|startoftext|>x", "日本語テキスト。 مرحبا 👍🏽!", "é é ́ ḱ.", "A" * 5000, "don't!! DON'T' 'LL 'll.", "tab\tnew\r\nline"]
    texts = odd + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()]
    found = T.WordEncoder(tokenizer).encode(pa.array(texts, pa.string()))
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:80]


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAbZ'.,!st \t\n019́")), max_size=40), max_size=8))
def test_any_text(tokenizer, texts):
    found = T.WordEncoder(tokenizer).encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_full_cache_starts_anew(tokenizer, monkeypatch):
    monkeypatch.setattr(T, "CACHED_WORDS", 3)
    encoder = T.WordEncoder(tokenizer)
    for text in ["one two three four five", "six one", "one two", ""]:
        assert encoder.encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_documents_against_the_library(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert got(T.token_report(docs)) == plain_report(rows, tokenizer)


@pytest.mark.parametrize("limits", [(1, 1), (700, 3), (10 ** 6, 10)])
def test_many_files_hold_one_array(spark, tokenizer, limits):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120).repartition(5)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    folder = scratch_dir(spark, "tokens-test")
    files = T.write_token_files(docs, folder, PATH, file_tokens=limits[0], file_docs=limits[1])
    assert got(T.read_documents(spark, folder, files)) == plain_report(rows, tokenizer)
    listed = sorted((r.part, r.number, r["name"], r.n_docs, r.start) for r in files.collect())
    assert [x[4] for x in listed] == np.concatenate([[0], np.cumsum([r.n_tokens for r in sorted(files.collect())])])[:-1].tolist()
    place = 0
    for _, _, name, n_docs, start in listed:  # a reader of one file: ids and offsets of a document by its place
        f = T.TokenFile(open(f"{folder.removeprefix('file:')}/{name}", "rb").read())
        for k in range(n_docs):
            want = tokenizer.encode(rows[place][1] or "", add_special_tokens=False).ids + [T.END_ID]
            assert f.doc_id(k) == rows[place][0] and f.ids(k).tolist() == want
            place += 1
    assert place == len(rows)


def test_a_second_attempt_writes_the_same_files(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(100)
    read = lambda f: {r.path.rsplit("/", 1)[1]: bytes(r.content) for r in spark.read.format("binaryFile").load(f).collect()}
    folder, other = scratch_dir(spark, "tokens-a"), scratch_dir(spark, "tokens-b")
    T.write_token_files(docs, folder, PATH, file_docs=20)
    first = read(folder)
    T.write_token_files(docs, folder, PATH, file_docs=20)
    T.write_token_files(docs, other, PATH, file_docs=20)
    assert first == read(folder) == read(other)


def test_a_cut_file_is_refused():
    data = T.file_bytes([None, 3], np.array([0, 1, 3]), np.array([7, 8, 9], "<u2"), 0, 0)
    assert T.TokenFile(data).doc_id(0) is None and T.TokenFile(data).ids(1).tolist() == [8, 9]
    with pytest.raises(ValueError):
        T.TokenFile(data[:-1])


def test_edges(spark, tokenizer):
    long = "Long word, " * 50_000
    docs = spark.createDataFrame(
        [(None, "b", 1), (None, "a", 1), (5, "", 2), (5, "", 2), (-3, None, 2), (2 ** 63 - 1, "x", 3), (-(2 ** 63), "y", 3), (9, long, 4), (7, " \n ", 4)],
        "doc_id bigint, text string, start int")
    rows = got(T.token_report(docs))
    assert [r[0] for r in rows] == [None, None, -(2 ** 63), -3, 5, 5, 7, 9, 2 ** 63 - 1]
    assert {r[3] for r in rows[:2]} == {r[3] for r in plain_report([(None, "a"), (None, "b")], tokenizer)}
    assert [r[1:] for r in rows[2:]] == [r[1:] for r in plain_report([(0, "a"), (0, "b"), (0, "y"), (0, None), (0, ""), (0, ""), (0, " \n "), (0, long),
                                                                      (0, "x")], tokenizer)[2:]]
    assert T.token_report(docs.limit(0)).count() == 0


def test_a_word_before_punctuation_is_known_in_every_script(tokenizer):
    encoder = T.WordEncoder(tokenizer)
    texts = ["été été. été, (été)", "жук жук!? ЖУК;", "naïf x² x²."]
    for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert set(encoder.pieces) == {"", "été", "(été", ".", ",", ")", "жук", "ЖУК", "!?", ";", "naïf", "x²"}


class Counted:
    """A tokenizer that counts the pieces given to it one by one."""

    def __init__(self, tokenizer):
        self.tokenizer, self.pieces = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode(self, given, is_pretokenized=False, **more):
        self.pieces += len(given) if is_pretokenized else 0
        return self.tokenizer.encode(given, is_pretokenized=is_pretokenized, **more)


def test_new_words_are_encoded_as_one_text(tokenizer):
    counted = Counted(tokenizer)
    words = [f"{a}{b}{c}" for a in "abcdefghxyzé" for b in "aeioué" for c in "lmnñ"]
    found = T.WordEncoder(counted).encode(pa.array([" ".join(words), "1x, a-b. " + words[0]]))
    assert [x.tolist() for x in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in (" ".join(words), "1x, a-b. " + words[0])]
    assert counted.pieces == 4  # 1x and a-b and the punctuation behind them


def test_letters_that_are_several_pieces(tokenizer, monkeypatch):
    monkeypatch.setattr(T, "JOINED", 50)
    letters = [chr(c) for c in [*range(0x41, 0x3000), *range(0xF900, 0xFFFF), *range(0x10400, 0x10500)] if not 0xD800 <= c < 0xE000]
    for word in (lambda c: c, lambda c: f"a{c}.", lambda c: f"{c}'s!", lambda c: f"É{c}b{c}\","):
        texts = [word(c) for c in letters]
        want = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert [x.tolist() for x in T.WordEncoder(tokenizer).encode(pa.array(texts))] == want
    marked = T.WordEncoder(tokenizer)
    marked.ends = np.ones_like(marked.ends)  # no count of ends fits: every piece is encoded apart
    assert [x.tolist() for x in marked.encode(pa.array(["one unbelievable thing"]))] == [tokenizer.encode("one unbelievable thing", add_special_tokens=False).ids]


def test_a_worker_loads_a_tokenizer_once(tmp_path, monkeypatch):
    import os
    import shutil

    path = str(shutil.copy(PATH, tmp_path / "tokenizer.json"))
    loaded, load = [], T.load_tokenizer
    monkeypatch.setattr(T, "load_tokenizer", lambda p: loaded.append(p) or load(p))
    first = T.encoder_at(path, os.stat(path).st_mtime_ns)
    assert T.encoder_at(path, os.stat(path).st_mtime_ns) is first and len(loaded) == 1
    assert T.encoder_at(path, 0) is not first and len(loaded) == 2  # another file stands there


def test_no_ends_where_ids_do_not_mark_them():
    from tokenizers import Tokenizer, models

    assert T.word_ends(Tokenizer(models.BPE(vocab={"a": 0, "b": 1}, merges=[]))) is None
    assert T.word_ends(Tokenizer(models.BPE(vocab={"a</w>": 0}, merges=[], end_of_word_suffix="</w>"))) is None
    assert T.word_ends(Tokenizer(models.WordLevel({"a": 0}, unk_token="a"))) is None
