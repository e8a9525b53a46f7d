"""Operators on the hand-made inputs of FIXTURES.md (reference examples)."""

from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.operators import aggregates as ag
from quern.operators import graph as gr
from quern.operators import grid as gd
from quern.operators import hierarchy as hi
from quern.operators import joins as jn
from quern.operators import predicates as pr
from quern.operators import sequences as sq

SCORES = [("Oda", "rowing", 61), ("Oda", "chess", 75), ("Oda", "dance", 44), ("Piet", "rowing", 88), ("Piet", "chess", 75),
          ("Rana", "dance", 90), ("Rana", "chess", 12), ("Sol", "rowing", 88), ("Sol", "dance", 31), ("Tove", "fencing", 57)]


def _series(spark, lists):
    rows = [(k, i, v) for k, vals in enumerate(lists) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "key long, pos long, val long")


def test_scores(spark):
    df = spark.createDataFrame(SCORES, "firstname string, subject string, score int")
    avg = {r[0]: round(r[1], 4) for r in ag.group_average(df, "firstname", "score").collect()}
    assert avg == {"Oda": 60.0, "Piet": 81.5, "Rana": 51.0, "Sol": 59.5, "Tove": 57.0}
    best = {r[0]: (r[1], r[2]) for r in ag.top_members(df, "subject", "score", "firstname", as_list=True).collect()}
    assert best == {"rowing": (88, ["Piet", "Sol"]), "chess": (75, ["Oda", "Piet"]), "dance": (90, ["Rana"]),
                    "fencing": (57, ["Tove"])}


def test_most_common_word(spark):
    df = spark.createDataFrame([("Bob hit a ball, the hit BALL flew far after it was hit.",)], "text string")
    r = ag.most_common_word(df, "text", ["hit"]).collect()
    assert (r[0]["word"], r[0]["n"]) == ("ball", 2)


def test_merge_intervals(spark):
    df = spark.createDataFrame([(1, 1, 3), (1, 2, 6), (1, 8, 10), (1, 15, 18)], "key long, st long, en long")
    got = sorted((r.st, r.en) for r in sq.merge_intervals(df, ["key"], "st", "en").collect())
    assert got == [(1, 6), (8, 10), (15, 18)]


def test_longest_no_loss_span(spark):
    df = _series(spark, [[6, 0, 8, 2, 1, 5], [9, 8, 1, 0, 1, 9, 4, 0, 4, 1]])
    got = {r.key: r.span for r in sq.longest_no_loss_span(df, ["key"], ["pos"], "val").collect()}
    assert got == {0: 4, 1: 7}


def test_dip_area(spark):
    df = _series(spark, [[2, 6, 3, 8, 2, 7, 2, 5, 0]])
    assert sq.dip_area(df, ["key"], ["pos"], "val").collect()[0].area == 11


def test_top_item(spark):
    rows = [(k, v) for k, vals in enumerate([[1, 2, 3, 3], [2, 1, 2, 5, 3, 2], [5, 1, 5, 2, 5, 3, 5, 4]]) for v in vals]
    df = spark.createDataFrame(rows, "id long, item long")
    got = {r.id: r.item for r in ag.top_k_frequent_by(df, "id", "item", 1).collect()}
    assert got == {0: 3, 1: 2, 2: 5}


def test_bulls_and_cows(spark):
    df = spark.createDataFrame([(1, "1122", "1222"), (2, "1807", "7810")], "id long, secret string, guess string")
    got = {r.id: r.hint for r in jn.bulls_and_cows(df, "id", "secret", "guess").collect()}
    assert got == {1: "3A0B", 2: "1A3B"}


def test_edit_distance(spark):
    df = spark.createDataFrame([("horse", "ros"), ("intention", "execution")], "a string, b string")
    got = [r.d for r in df.select(F.levenshtein("a", "b").alias("d")).collect()]
    assert got == [3, 5]
    words = spark.createDataFrame([("cat",), ("cut",), ("cats",), ("dog",), ("at",)], "w string")
    pairs = {(r.w1, r.w2) for r in jn.edit_distance_join(words, "w", 1).collect()}
    assert pairs == {("cat", "cut"), ("cat", "cats"), ("at", "cat")}


def test_word_ladder(spark):
    words = spark.createDataFrame([(w,) for w in "hot cog dog tot hog hop pot dot".split()], "w string")
    e = gr.one_letter_edges(words, "w")
    src = spark.createDataFrame([("hot",)], "w string")
    got = {r.node: (r.dist, r.paths) for r in gr.bfs_distance(e, src, nodes=words).collect()}
    assert got["dog"] == (2, 2)  # hot -> hog -> dog and hot -> dot -> dog: 3 words, two paths


def test_substring_concatenation(spark):
    text, wlen = "wordgoodgoodgoodbestword", 4
    rows = [(i % wlen, i, text[i:i + wlen]) for i in range(len(text) - wlen + 1)]
    df = spark.createDataFrame(rows, "cls long, pos long, w string")
    got = sq.bag_match_windows(df, ["cls"], ["pos"], "w", {"word": 1, "good": 2, "best": 1}).collect()
    starts = sorted(r.cls + (r.start_pos - 1) * wlen for r in got)
    assert starts == [8]


def test_rotate(spark):
    cells = spark.createDataFrame([(r, c, r * 4 + c + 1) for r in range(4) for c in range(4)],
                                  "row long, col long, val long")
    t = gd.reindex(cells).where("rot_row = 0").orderBy("rot_col").collect()
    assert [r.val for r in t] == [13, 9, 5, 1]


def test_sudoku_audit(spark):
    board = ["53..7....", "6..195...", ".98....6.", "8...6...3", "4..8.3..1", "7...2...6", ".6....28.",
             "...419..5", "....8..79"]
    cells = [(r, c, ch) for r, line in enumerate(board) for c, ch in enumerate(line)]
    ok = spark.createDataFrame(cells, "row long, col long, val string")
    assert ag.key_audit(ok, "row", "col", "val").count() == 0
    bad = [(r, c, "8" if (r, c) == (0, 0) else v) for r, c, v in cells]
    assert ag.key_audit(spark.createDataFrame(bad, "row long, col long, val string"), "row", "col", "val").count() > 0


def test_outline(spark):
    lines = spark.createDataFrame([(1, "dir"), (2, "    file.txt")], "line_no long, line string")
    got = hi.outline_paths(lines).where("is_file").agg(F.max("path_length")).collect()[0][0]
    assert got == 12
    lines = spark.createDataFrame([(1, "dir"), (2, "\tsubdir1"), (3, "\tsubdir2"), (4, "\t\tfile.ext")],
                                  "line_no long, line string")
    got = hi.outline_paths(lines).where("is_file").collect()
    assert [r.path for r in got] == ["dir/subdir2/file.ext"]


def test_chain_reverse(spark):
    nxt = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, None)], "node long, next long")
    got = {r.node: r.reversed_pos for r in gr.chain_rank(nxt).collect()}
    assert [n for n, _ in sorted(got.items(), key=lambda kv: kv[1])] == [4, 3, 2, 1]


def test_rate_limit_messages(spark):
    msgs = [(1, "foo", 1), (2, "bar", 2), (3, "foo", 3), (4, "bar", 8), (5, "foo", 10), (6, "foo", 11)]
    df = spark.createDataFrame(msgs, "id long, key string, t long")
    got = {r.id: r.allowed for r in sq.rate_limit(df, ["key"], "t", "id", 10).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: False, 6: True}


def test_recent_pings(spark):
    df = spark.createDataFrame([(1, 0, 1), (2, 0, 100), (3, 0, 3001), (4, 0, 3002)], "id long, k long, t long")
    got = {r.id: r.recent for r in sq.recent_count(df, ["k"], "t", F.lit(3000), "id").collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3}


def test_time_based_store(spark):
    log = spark.createDataFrame([("foo", 1, "bar"), ("foo", 4, "bar2")], "key string, ts long, value string")
    gets = spark.createDataFrame([("foo", 1), ("foo", 3), ("foo", 4), ("foo", 5), ("foo", 0)], "key string, t long")
    got = {r.t: r.r_value for r in jn.asof_join(gets, log, ["key"], "t", "ts", ["value"]).collect()}
    assert got == {1: "bar", 3: "bar", 4: "bar2", 5: "bar2", 0: None}


def test_proper_case(spark):
    df = spark.createDataFrame([("o'neil and 4-not specified",), (None,)], "s string")
    got = [r[0] for r in df.select(tx.proper_case("s")).collect()]
    assert got == ["O'Neil And 4-Not Specified", None]


def test_fizz_buzz(spark):
    df = spark.range(1, 16).withColumnRenamed("id", "n")
    got = [r.label for r in pr.rule_label(df, "n").orderBy("n").collect()]
    assert got[:5] == ["1", "2", "Fizz", "4", "Buzz"] and got[14] == "FizzBuzz"


def test_distinct_normal_forms(spark):
    emails = spark.createDataFrame([("first.last+news@example.com",), ("fir.stlast+shop.list@example.com",),
                                    ("firstlast+x@ex.ample.com",)], "e string")
    assert ag.distinct_normalised(emails, tx.email_normal_form("e")).collect()[0][0] == 2
    assert ag.distinct_normalised(emails, tx.email_normal_form("e"), approx=True).collect()[0][0] == 2
    words = spark.createDataFrame([("gin",), ("zen",), ("gig",), ("msg",)], "w string")
    codes = {r[0] for r in words.select(tx.morse_code("w")).collect()}
    assert codes == {"--...-.", "--...--."}


def test_median_forms(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (2.0,)], "v double")
    assert ag.exact_median(df, "v").collect()[0][0] == 1.0
    df2 = spark.createDataFrame([(1.0,), (3.0,), (2.0,), (4.0,)], "v double")
    assert ag.exact_median(df2, "v").collect()[0][0] == 2.5
    assert ag.exact_median(df2, "v", approx=True).collect()[0][0] in (2.0, 3.0)
