import random

from llm_fixtures import WORD, docs_of, edge_docs, empty_docs

from quern.llm import line_dedup


def corpus(seed, n=40):
    """Documents of short lines, with shared passages of 1 to 6 lines."""
    rng = random.Random(seed)
    def line(k):
        return " ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 400)) for _ in range(k))
    shared = [[line(rng.randint(5, 30)) for _ in range(rng.randint(1, 6))] for _ in range(8)]
    texts = []
    for _ in range(n):
        out = []
        for _ in range(rng.randint(1, 5)):
            out += [line(rng.randint(1, 40)) for _ in range(rng.randint(0, 3))] + rng.choice([[], [""], ["same short line"]])
            if rng.random() < 0.5:
                out += rng.choice(shared)
        texts.append("\n".join(out))
    return texts, shared


def slow_dedup(texts, min_words=50):
    """Every run of lines that also stands, in full, at an earlier place."""
    docs = [[(i, x.strip()) for i, x in enumerate(t.split("\n")) if WORD.search(x)] for t in texts]
    gone = [set() for _ in texts]
    for b, later in enumerate(docs):
        for a in range(b + 1):
            for j in range(len(later)):
                for i in range(len(docs[a]) if a < b else j):
                    n = words = 0
                    while i + n < len(docs[a]) and j + n < len(later) and docs[a][i + n][1] == later[j + n][1]:
                        words += len(WORD.findall(later[j + n][1]))
                        n += 1
                    if words >= min_words:
                        gone[b].update(later[k][0] for k in range(j, j + n))
    return ["\n".join(x for i, x in enumerate(t.split("\n")) if i not in g) for t, g in zip(texts, gone)]


def test_deletes_just_what_comparing_all_runs_deletes(spark):
    for seed in range(3):
        texts, shared = corpus(seed)
        got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(spark, texts)).collect()}
        left = [got[i].split("\n") for i in range(len(texts))]
        assert left == [x.split("\n") for x in slow_dedup(texts)]
        for passage in shared:
            words = sum(len(x.split()) for x in passage)
            seen = [sum(x == y for d in left for y in d) for x in passage]
            before = [sum(x == y for t in texts for y in t.split("\n")) for x in passage]
            if words >= 50:
                assert seen == [min(n, 1) for n in before]


def test_runs_around_lines_that_stand_everywhere(spark):
    """A line of a gram's length in many documents: the first place of its
    fingerprint is another document than the one a run repeats."""
    for seed in range(3):
        rng = random.Random(100 + seed)
        line = lambda k: " ".join(f"x{rng.randint(0, 10**6)}" for _ in range(k))
        common = [line(k) for k in (25, 30, 60, 26)]
        pool = [line(rng.randint(1, 30)) for _ in range(12)]
        texts = ["\n".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(pool) if rng.random() < 0.8 else line(9)
                           for _ in range(rng.randint(1, 12))) for _ in range(60)]
        texts += ["\n".join([line(12), common[0], line(12)]), "\n".join(["a " * 20, common[0], "b " * 20]),
                  "\n".join([line(3), "a " * 20, common[0], "b " * 20, line(3)])]
        got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(spark, texts)).collect()}
        assert [got[i] for i in range(len(texts))] == slow_dedup(texts)


def test_edges(spark):
    docs = edge_docs(spark)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns + ["_dedup"]
    got = out.collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.text)
    base = docs.where("doc_id = 1").first().text
    assert by[1] == [base] and by[2] == [""] and by[5] == [None] and by[4] == [""] and by[7] == ["one two"] * 2
    assert sorted(by[None], key=repr) == ["", None]  # no id comes last in the order: the copy of 1 goes
    assert line_dedup.dedup_lines(empty_docs(spark)).collect() == []


def test_repeats_inside_one_text_keep_the_first(spark):
    line = " ".join(f"w{i}" for i in range(20))
    text = "\n".join([line] * 200)
    got = line_dedup.dedup_lines(docs_of(spark, [text])).first()
    assert got.text == line and got._dedup.n_removed == 199
