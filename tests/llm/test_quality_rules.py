from collections import Counter

from llm_fixtures import WORD, docs_of, edge_docs, empty_docs

from quern.llm import quality_rules


def slow_counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed)


def test_counts_match_brute_force(spark):
    docs = edge_docs(spark)
    want = sorted(((r.doc_id, *slow_counts(r.text)) for r in docs.collect()), key=repr)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = quality_rules.quality(docs)
    assert sorted((tuple(r) for r in got.select(cols).collect()), key=repr) == want
    assert all(not (r.base_failed and r.kept) for r in got.collect())
    assert quality_rules.quality(empty_docs(spark)).collect() == []


def test_lines_are_removed_before_the_document_is_judged(spark):
    clean = ("Then the old road turned past the mill and down to the harbour, where boats lay.\n"
             "Nobody had come this way since the rain began, and the fields were quiet.")
    menu = "Home | About | Contact | Help"
    texts = [clean, clean + "\n" + menu, "\n".join([menu + f" {i}" for i in range(9)]) + "\n" + clean[:40],
             "Wow### this$$$ is*** all&&& noise%%% here### and*** there&&& too$$$ friend###",
             "We use cookies to run this site and by staying you accept them all, thanks a lot."]
    got = {r.doc_id: r for r in quality_rules.quality(docs_of(spark, texts)).collect()}
    assert [got[i].kept for i in range(5)] == [True, True, False, False, False]
    assert got[1].cleaned_text == clean and got[1].lost_words == 7
    assert got[3].cleaned_text == "" and got[4].cleaned_text == ""
