"""Token counts and SentencePiece digests against the libraries, char by char
classes and odd texts included."""

import hashlib
import random
import sys

import public_tokenizers
import pytest

from splitlens.llm import piece_codec as P
from splitlens.llm import token_counts as C
from splitlens.llm.common import table
from tests.conftest import SF_SMALL

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "   ", "a", " a", "  a", "a  ", "don't we'll I'm  x's", "a\n\n b\t\tc \r\n", "x<|endoftext|>y", "<|endoftext|>",
         "<|endoftext|><|endoftext|> z", "<|endoftext|", "</s> <s> <unk> <0x41>", "▁x ▁▁ y▁", "▁", "a\x00b\x1c\x85 c d　", "12345 67.89",
         "日本語 テキスト 🤖🤖 한국어", "é ﻿ x ​", "ﬁ ① Ⅷ ½ ²", "!!! ??? $$$%%%", "a" * 3000, "ab " * 4000, " " * 700, "\n" * 300,
         "".join(chr(random.Random(7).randrange(32, 0x2FFF)) for _ in range(3000)), "z" * 120 + "é" * 4000]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, "again", "x", 1), (3, "again", "x", 1), (None, "no id", "x", 1)],
                                 "doc_id long, text string, id string, n_bytes int")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BPE)


def counts(df):
    return sorted((r["doc_id"] is None, r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in C.count_tokens(df, BPE).collect())


def library_counts(library, df):
    out = []
    for r in df.select("doc_id", "text").collect():
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        out.append((r["doc_id"] is None, r["doc_id"], len((r["text"] or "").encode()), n, n > 512))
    return sorted(out)


def test_counts_of_odd_texts(spark, library):
    df = frame(spark, TEXTS)
    assert counts(df) == library_counts(library, df)


def test_counts_of_the_table(spark, library):
    df = table(spark, SF_SMALL, "documents", "doc_id", "text")
    assert counts(df) == library_counts(library, df)


def test_every_character_is_classed_as_in_the_library(library):
    """Each code point between letters, digits and blanks is cut as the library cuts it."""
    import regex
    words, wrong = regex.compile(C.PATTERN).findall, []
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(chars), 2000):
        part = chars[at:at + 2000]
        for c, got in zip(part, (library.pre_tokenizer.pre_tokenize_str(f"a{c}1 {c}{c} ,{c}") for c in part)):
            if len(got) != len(words(f"a{c}1 {c}{c} ,{c}")):
                wrong.append(c)
    assert not wrong, [hex(ord(c)) for c in wrong[:20]] + [len(wrong)]


def test_whole_tokens_are_proved(library):
    whole = C.Vocabulary(BPE).whole
    sample = random.Random(1).sample(sorted(whole), 3000)
    assert all(len(library.encode(w, add_special_tokens=False).ids) >= 1 for w in sample)
    symbols = C.byte_symbols()
    assert all(len(library.model.tokenize("".join(symbols[b] for b in w.encode()))) == 1 for w in sample)
    assert 40_000 < len(whole) < 50_257


def test_merging_equals_the_library(library):
    ranks, symbols, rng = C.Vocabulary(BPE).ranks, C.byte_symbols(), random.Random(5)
    for _ in range(3000):
        word = "".join(rng.choice("abcdeéthionrsl 0127.,") for _ in range(rng.randrange(1, 40)))
        mapped = "".join(symbols[b] for b in word.encode())
        assert C.merged(list(mapped), ranks) == [t.value for t in library.model.tokenize(mapped)]


def test_other_files_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        C.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def piece_rows(df, **kw):
    return sorted((r["doc_id"] is None, r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in P.encode_decode(df, PIECES, **kw).collect())


def library_pieces(df):
    import sentencepiece
    sp, out = sentencepiece.SentencePieceProcessor(model_file=PIECES), []
    for r in df.select("doc_id", "text").collect():
        ids = sp.encode(r["text"] or "", add_eos=True)
        out.append((r["doc_id"] is None, r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))))
    return sorted(out)


def test_pieces_of_odd_texts(spark):
    df = frame(spark, TEXTS)
    assert piece_rows(df) == library_pieces(df) == piece_rows(df, keep=True)


def test_pieces_of_the_table(spark):
    df = table(spark, SF_SMALL, "documents", "doc_id", "text")
    assert piece_rows(df) == library_pieces(df)


def test_long_texts_without_blanks_are_not_remembered(spark):
    """2,000 texts of 100 KB, each one chunk: a worker stays far below their 200 MB."""
    import resource

    texts = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "concat(repeat(concat('日本', id), 12000), id) AS text")
    done = P.encode_decode(texts, PIECES)

    def peak(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "kb": [resource.getrusage(resource.RUSAGE_SELF).ru_maxrss]})

    rows = done.mapInArrow(peak, "n long, kb long").collect()
    assert sum(r["n"] for r in rows) == 2000 and max(r["kb"] for r in rows) < 700_000


def test_kept_ids_and_text(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df = frame(spark, ["a b  c", "", "é▁x"])
    for r in P.encode_decode(df, PIECES, keep=True).where("doc_id in (0, 1, 2)").collect():
        text = df.where(df.doc_id == r["doc_id"]).first()["text"]
        assert r["ids"] == sp.encode(text, add_eos=True) and r["decoded"] == sp.decode(r["ids"])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert C.count_tokens(empty, BPE).collect() == [] and P.encode_decode(empty, PIECES).collect() == []
