"""Operators 2, 3, 7: against the libraries on whole texts, brute force and round trips."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from conftest_llm import BYTES, PIECES, prose, texts
from yoyflow.llm import token_files
from yoyflow.llm.common import Memo, pooled
from yoyflow.llm.pieces import PieceModel, best_paths, expected_counts, marginals
from yoyflow.llm.sentencepiece_codec import decode, decode_ids, encode, encode_texts
from yoyflow.llm.token_counts import TokenCountCache, token_counts
from yoyflow.llm.tokenizers import MARKER, ByteLevelCoder, CodeTable
from yoyflow.llm.token_counts import _PieceCounter
from yoyflow.llm.trie import DoubleArrayTrie
from yoyflow.session import new_stage

sp = SentencePieceProcessor(model_file=PIECES)
bpe = Tokenizer.from_file(BYTES)
spaced = st.lists(st.sampled_from([*" \n\t\r\x0b\x0c\x1c\x85\xa0 ▁ab'sé.日", "<|endoftext|>", " "]), max_size=40).map("".join)
coder, counter = ByteLevelCoder(BYTES, "<u4"), _PieceCounter(PIECES)


@settings(max_examples=400, deadline=None)
@given(st.one_of(spaced, st.text(max_size=60)))
def test_pieces_of_a_text_give_the_text(text):
    assert counter([text])[0] == len(sp.encode(text))
    assert np.frombuffer(coder([text])[0], "<u4").tolist() == bpe.encode(text, add_special_tokens=False).ids


def test_special_strings_are_as_in_the_library():
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  <|endoftext|>"):
        assert np.frombuffer(coder([text])[0], "<u4").tolist() == bpe.encode(text, add_special_tokens=False).ids


def test_a_word_reaches_the_library_once_whatever_stands_after_it():
    own, asked = ByteLevelCoder(BYTES, "<u4"), []
    encode = own._encode
    own._encode = lambda words: [asked.append(len(words)), encode(words)][1]
    words = [f"{a}{b}ing" for a in "bcdfgklmnp" for b in ("a", "e", "o", "u", "ar", "er", "or", "ur")]
    for sep in (" ", ", ", ". ", "; ", ": ", "! ", "? ", ".\n "):
        text = "so " + sep.join(words)
        assert np.frombuffer(own([text])[0], "<u4").tolist() == bpe.encode(text, add_special_tokens=False).ids
    assert sum(asked) <= len(words) + 10


def test_special_strings_with_marks_or_letters_are_not_cut(tmp_path):
    for special in ("a.b", "x,", "abc", "...", "é.", "<s>"):
        other = Tokenizer.from_file(BYTES)
        other.add_special_tokens([special])
        path = str(tmp_path / f"{len(list(tmp_path.iterdir()))}.json")
        other.save(path)
        own = ByteLevelCoder(path, "<u4")
        for text in (special, f"wa.bc a.b abc. x,y x, {special}z", f"z{special}.\n{special}", f"xabcy... é... {special} {special}"):
            assert np.frombuffer(own([text])[0], "<u4").tolist() == other.encode(text, add_special_tokens=False).ids


def test_code_table_stays_small_and_right():
    asked = []
    known = CodeTable(lambda words: [asked.extend(words.to_pylist()), words.cast(pa.binary())][1], most=2000)
    for i in range(300):
        words = ["common", f"w{i}", "common", f"v{i}" * 3]
        assert known.lookup(pa.array(words)).to_pylist() == [w.encode() for w in words] and known.nbytes <= 2000
    assert asked.count("common") == 1
    assert known.lookup(pa.array(["x" * 5000, "common"])).to_pylist() == [b"x" * 5000, b"common"] and known.nbytes <= 2000
    small = ByteLevelCoder(BYTES, "<u4")
    small._known = CodeTable(small._encode, most=500)
    for text in texts():
        assert np.frombuffer(small([text or ""])[0], "<u4").tolist() == bpe.encode(text or "", add_special_tokens=False).ids


def test_texts_are_encoded_from_a_part_of_a_column():
    column = pa.array(["", "left out", None, "é.\nA  b ", "", "日本 \u3000x", None])
    for kind in (pa.string(), pa.large_string()):
        given = pc.fill_null(column.cast(kind), "")
        want = [bpe.encode(t, add_special_tokens=False).ids for t in given.to_pylist()]
        for a in range(len(given) + 1):
            got = coder.encode(given.slice(a)).to_pylist()
            assert [np.frombuffer(g, "<u4").tolist() for g in got] == want[a:]


def test_pooled_batches_keep_rows_and_order():
    rows = [None if i % 7 == 0 else "x" * (i % 30) for i in range(200)]
    batches = [pa.record_batch({"i": pa.array(range(a, a + 8)), "text": pa.array(rows[a : a + 8], pa.string())}) for a in range(0, 200, 8)]
    got = list(pooled(iter(batches), "text", 500))
    assert [x for b in got for x in b.column("i").to_pylist()] == list(range(200))
    assert [x for b in got for x in b.column("text").to_pylist()] == rows
    assert 5 < len(got) < len(batches) and list(pooled(iter([]), "text", 500)) == []


def test_memo_keeps_words_in_use_and_stays_small():
    seen = []
    memo = Memo(lambda words: [seen.append(w) or w.upper() for w in words], limit=10)
    for i in range(200):
        memo.ensure([["common", f"w{i}"], [f"v{i}"]])
        assert memo["common"] == "COMMON" and memo[f"w{i}"] == f"W{i}" and len(memo) <= 12
    assert seen.count("common") == 1


def test_counts_and_cache(spark, messy, no_rows):
    path = new_stage(spark)
    got = token_counts(messy, PIECES, path)
    assert got.columns.count("n_tokens") == 1
    for r in got.collect():
        assert r.n_tokens == len(sp.encode(r.text or "")) and r.n_bytes == len((r.text or "").encode())
    assert got.count() == messy.count()
    cache = TokenCountCache(spark, path, PIECES)
    stored = spark.read.parquet(cache.path).count()
    assert stored == cache.read().count() == len({t or "" for t in [*texts(), "no id"]})
    token_counts(messy, PIECES, path).count()
    assert spark.read.parquet(cache.path).count() == stored  # nothing was encoded again
    more = spark.createDataFrame([(1, "quite new"), (2, "word")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts(more, PIECES, path).collect()} == {1: len(sp.encode("quite new")), 2: 1}
    assert spark.read.parquet(cache.path).count() == stored + 1
    assert TokenCountCache(spark, path, BYTES).path != cache.path
    assert {r.n_tokens for r in token_counts(more, BYTES, path).collect()} == {len(bpe.encode(t).ids) for t in ("quite new", "word")}
    assert token_counts(no_rows, PIECES, new_stage(spark)).count() == 0


def test_trie_finds_every_occurrence():
    r = random.Random(5)
    keys = sorted({"".join(r.choice("abcd") for _ in range(r.randint(1, 6))).encode() for _ in range(300)})
    data = "".join(r.choice("abcde") for _ in range(500)).encode()
    start, length, value = DoubleArrayTrie(keys).matches(np.frombuffer(data, np.uint8))
    want = {(i, len(k), v) for v, k in enumerate(keys) for i in range(len(data)) if data.startswith(k, i)}
    assert set(zip(start.tolist(), length.tolist(), value.tolist(), strict=True)) == want and len(start) == len(want)
    assert len(DoubleArrayTrie([]).matches(np.frombuffer(data, np.uint8))[0]) == 0


def _edges(model, word):
    text = MARKER + word.replace(" ", MARKER)
    names = {sp.id_to_piece(i): i for i in model.ids.tolist()}
    for a in range(len(text)):
        single = False
        for b in range(a + 1, min(len(text), a + 20) + 1):
            if text[a:b] in names:
                single |= b == a + 1
                yield a, b, [names[text[a:b]]], model.scores[names[text[a:b]]]
        if not single:
            ids = [int(model.byte_ids[x]) for x in text[a].encode()]
            yield a, a + 1, ids, sum(model.scores[i] for i in ids) if model.unknown is None else model.unknown


@pytest.mark.parametrize("scores", ["zipf", "file"])
def test_paths_against_plain_recursion(scores):
    model = PieceModel.load(PIECES, scores)
    words = ["the", "then", "a", "", "über", "日本🙂x", "a b", " lead", "trail ", "xxxxxxxxx", "internationalization", "ሀab", *prose(8, 40).split()]
    for word, (ids, score), total in zip(words, best_paths(model, words), marginals(model, words), strict=True):
        n = len(MARKER + word)
        best, whole = {0: (0.0, [])}, {0: 0.0}
        for b in range(1, n + 1):
            into = [e for e in _edges(model, word) if e[1] == b]
            best[b] = max(((best[a][0] + s, -a, best[a][1] + i) for a, _, i, s in into), key=lambda x: x[:2])[::2]
            whole[b] = np.logaddexp.reduce([whole[a] + s for a, _, _, s in into])
        assert score == pytest.approx(best[n][0]) and total == pytest.approx(whole[n])
        assert np.frombuffer(ids, "<i4").tolist() == best[n][1]


def test_expected_counts_are_the_marginals_derivative():
    model, words, times = PieceModel.load(PIECES), ["then", "日x", "banana"], np.array([2.0, 1.0, 3.0])
    counts = expected_counts(model, words, times)
    for i in np.argsort(-counts)[:6].tolist():
        up, down = (PieceModel(**{**model.__dict__, "scores": model.scores + e * (np.arange(len(model.scores)) == i)}) for e in (1e-5, -1e-5))
        slope = (np.dot(marginals(up, words), times) - np.dot(marginals(down, words), times)) / 2e-5
        assert counts[i] == pytest.approx(slope, rel=1e-3)


@settings(max_examples=100, deadline=None)
@given(st.one_of(spaced, st.text(max_size=40)))
def test_round_trip_and_whole_text_path(text):
    model = _zipf
    (ids,), (score,) = encode_texts(model, [text])
    assert decode_ids(model, np.frombuffer(ids, "<i4")) == text.replace(MARKER, " ")
    if text:
        whole, whole_score = best_paths(model, [text])[0]
        assert ids == whole and score == pytest.approx(whole_score)


_zipf = PieceModel.load(PIECES)


def test_encode_and_decode_frames(messy, no_rows):
    got = decode(encode(messy, PIECES), PIECES)
    for r in got.collect():
        assert r.decoded == (r.text or "").replace(MARKER, " ") and (r.piece_ids == []) == (not r.text)
    assert got.count() == messy.count()
    assert encode(no_rows, PIECES).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.sampled_from([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24])))
def test_pack_round_trip(ranks):
    control, data = token_files.pack(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert token_files.unpack(control, data, len(ranks)).tolist() == ranks


def test_token_files(spark, messy, no_rows):
    path, first = new_stage(spark), -1  # the document without id stands first
    token_files.write_tokens(messy, path, BYTES, end_id=0, block_tokens=500)
    got = sorted((r.start, first if r.doc_id is None else r.doc_id, r.n_tokens, bytes(r.ids)) for r in token_files.read_tokens(spark, path).collect())
    want = sorted((first if r.doc_id is None else r.doc_id, np.array([*bpe.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for r in messy.collect())
    assert sorted((g[1], g[3]) for g in got) == want
    at = 0
    for start, _, n, ids in got:
        assert start == at and n == len(ids) // 4
        at += n
    assert [g[1] for g in got] == sorted(g[1] for g in got)
    empty = new_stage(spark)
    token_files.write_tokens(no_rows, empty, BYTES, end_id=0)
    assert token_files.read_tokens(spark, empty).count() == 0
