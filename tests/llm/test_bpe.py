import hashlib
import random

import pytest
from llm_fixtures import docs_of, edge_docs, empty_docs

from quern.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_ids_and_text_match_the_library(library):
    own, rng = bpe.load(PATH), random.Random(1)
    texts = ["", " \n", "Hello world's THE end", "<|endoftext|>a<|startoftext|>", "a<|endoftext|", "ΣΑΣ ας", "é É İ ǅ", "日本語 かな",
             "x" * 5000, "näive 12 345", "౜Ɤ", "a\x00b\x1fc\x85d e", "</w> <w>", "𝔘nicode 🙂🙂🙂"]
    texts += ["".join(rng.choice("aeiou thnsrlm'’<|>09ÉéßΣσ!?.,\n\t́") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    texts += [chr(c) + "b" for c in range(0, 0x3000) if not 0xD800 <= c < 0xE000]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        got = own.encode(t).tolist()
        assert got == want, t
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)


def test_every_token_is_the_encoding_of_its_text(library):
    own = bpe.load(PATH)
    for t in list(library.get_vocab())[::7]:
        t = t.replace("</w>", "")
        assert own.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids


def test_a_full_table_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "_TABLE_WORDS", 8)
    own = bpe.WordBpe(PATH)
    t = " ".join(f"word{i % 13} plus{i}" for i in range(300))
    assert own.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids
    assert len(own._table) <= 8


def test_query_columns(spark, library):
    docs = edge_docs(spark)
    encoded = bpe.encode(docs, PATH)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in bpe.digests(encoded, PATH).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert bpe.decode(bpe.encode(docs_of(spark, ["A b"]), PATH), PATH).first().text == "a</w> b</w>"
    assert bpe.digests(bpe.encode(empty_docs(spark), PATH), PATH).collect() == []
