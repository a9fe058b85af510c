"""Token files of texts with the tokenizer's own tokens, of long texts and of many rows without id."""

import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hopscope.llm import rans
from hopscope.llm.queries import tokenizer_path
from tests.llm.test_operators import docs_df, words


def test_added_tokens_are_those_of_the_tokenizer():
    plain = Tokenizer.from_file(tokenizer_path())  # as anyone opens it
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "<|endoftext> <|", "no such token", ""]
    tokens = rans.Tokens(tokenizer_path())
    got = [np.frombuffer(x, tokens.dtype).tolist() for x in tokens.encode(texts)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[0] == [505, 220, 50256, 734]


def test_long_texts_and_a_third_without_id(spark):
    plain = Tokenizer.from_file(tokenizer_path())
    rows = [(i, " ".join(words(20, i)), "s") for i in range(40)] + [(None, " ".join(words(9, 100 + i % 7)), "s") for i in range(30)]
    rows += [(7, "word soup " * 200_000, "s"), (8, "x<|endoftext|>y", "s")]
    got = rans.token_files(docs_df(spark, rows), tokenizer_path(), file_tokens=100_000, partitions=5).orderBy("start").collect()
    told = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got)
    want = []
    for doc, text, _ in rows:
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((doc is not None, doc or 0, len(ids), zlib.crc32(ids.tobytes())))
    assert told == sorted(want)
    starts = np.cumsum([0] + [r["n_tokens"] for r in got])
    assert [r["start"] for r in got] == starts[:-1].tolist()
    order = [r["doc_id"] if r["doc_id"] is not None else -1 for r in got]
    assert order == sorted(order)


def test_rows_without_id_fill_several_files(spark, tmp_path):
    rows = [(None, f"text number {i}", "s") for i in range(400)]
    files = rans.write_tokens(docs_df(spark, rows), tokenizer_path(), f"file://{tmp_path}/t", partitions=4)
    assert files.count() == 4 and files.agg(F.max("n_docs")).first()[0] < 200


def test_words_of_all_kinds_are_parted_as_the_tokenizer_does():
    plain = Tokenizer.from_file(tokenizer_path())
    ends = ["word", "it's", "('s", "I'LL", "x''re", "'tis", "12ab3", "été,", "naïve!", "«Œuvre»", "Ёлка…", "λόγος", "3²", "a×b", "日本語", "a\n\nb", "a\n\n\nb", "a\nb", "\n", "x\n", "\tx", "a\tb", "\x01", "a\x02b", "\x1cq", "\xa0", "a\xa0b", "éa", "😀x", ""]
    texts = [*ends, *(f"{a} {b}" for a in ends for b in ends), *(f"Say {a} {b} end" for a in ends for b in ends[:9])]
    tokens = rans.Tokens(tokenizer_path())
    tokens.KEPT, tokens.LEARNED, tokens.GATHERED = 40, 5, 7  # some words are forgotten and met again, ids come in many pieces
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    for step in (1, 50, len(texts)):
        got = [x for lo in range(0, len(texts), step) for x in tokens.encode(texts[lo : lo + step])]
        assert [np.frombuffer(x, tokens.dtype).tolist() for x in got] == want


def test_each_new_word_is_encoded_once_and_few_calls_are_made():
    tokens, calls = rans.Tokens(tokenizer_path()), []
    whole, model = tokens.ids, tokens.model_ids
    tokens.ids = lambda texts: calls.append(len(texts)) or whole(texts)
    tokens.model_ids = lambda runs: calls.append(1) or model(runs)
    texts = [" ".join(words(60, i)) + "\n\nEt l'été, it's over." for i in range(300)]
    tokens.encode(texts)
    known = len(tokens.words)
    tokens.encode(texts)
    assert sum(calls) == 1 and len(tokens.words) == known


def test_long_words_do_not_stay():
    tokens = rans.Tokens(tokenizer_path())
    tokens.KEPT_BYTES = 1000
    for i in range(50):
        tokens.encode([f"a {chr(0x4E00 + i) * 200} b"])
        assert tokens.words.nbytes < 5000
