"""Join operators (survey 2.3).

Catalyst turns only equalities into hash keys, so every band, sum or
similarity predicate here is rewritten into an equi-join on a derived key
(complement value, bucket, deletion neighbourhood, bit band) and verified
after the join.  No cross join except the k x k one of ``k_smallest_pairs``,
whose sides are bounded by k.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.asof import asof_lookup
from ..plans.keys import key_join
from ..plans.loops import materialize
from ..plans.scan import Agg, ordered_scan, reusable, row_index


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _keq(keys: Sequence[str], a: str, b: str) -> list[Column]:
    return [F.col(f"{a}{k}").eqNullSafe(F.col(f"{b}{k}")) for k in keys]


def complement_pairs(df: DataFrame, keys: Sequence[str], val: str, target) -> DataFrame:
    """Value pairs (v_lo <= v_hi) with v_lo + v_hi = target per key and how
    many row pairs i < j make them.  Rows are counted per value first, so a
    hot value costs one row, not its square."""
    c = df.groupBy(*keys, val).agg(F.count(F.lit(1)).alias("_n"))
    a = c.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.col(val).alias("v_lo"), F.col("_n").alias("_na"))
    b = c.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col(val).alias("v_hi"), F.col("_n").alias("_nb"))
    j = a.join(b, _keq(keys, "_a_", "_b_") + [F.col("v_hi") == F.lit(target) - F.col("v_lo")])
    j = j.where(F.col("v_lo") <= F.col("v_hi"))
    # exact: n * (n - 1) / 2 with the even factor halved first
    half = F.expr("CASE WHEN _na % 2 = 0 THEN (_na div 2) * (_na - 1) ELSE _na * ((_na - 1) div 2) END")
    n = F.when(F.col("v_lo") == F.col("v_hi"), half).otherwise(F.col("_na") * F.col("_nb")).cast("long")
    return (j.select(*[F.col(f"_a_{k}").alias(k) for k in keys], "v_lo", "v_hi", n.alias("n_pairs"))
            .where(F.col("n_pairs") > 0))


def first_complement_pair(df: DataFrame, keys: Sequence[str], val: str, id_col: str, target) -> DataFrame:
    """The reference's single answer: per key the pair (i, j), i < j, with the
    smallest (i, j) among all pairs summing to target, without listing pairs:
    per value the two smallest ids are enough."""
    c = df.groupBy(*keys, val).agg(F.min(id_col).alias("_i1"))
    second = (key_join(df, c.select(*keys, val, "_i1"), [*keys, val])
              .where(F.col(id_col) > F.col("_i1")).groupBy(*keys, val).agg(F.min(id_col).alias("_i2")))
    c = key_join(c, second, [*keys, val], "left")
    a = c.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.col(val).alias("_va"), F.col("_i1").alias("_ai1"),
                 F.col("_i2").alias("_ai2"))
    b = c.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col(val).alias("_vb"), F.col("_i1").alias("_bi1"))
    j = a.join(b, _keq(keys, "_a_", "_b_") + [F.col("_vb") == F.lit(target) - F.col("_va")])
    i = F.when(F.col("_va") == F.col("_vb"), F.col("_ai1")).otherwise(F.least("_ai1", "_bi1"))
    jj = F.when(F.col("_va") == F.col("_vb"), F.col("_ai2")).otherwise(F.greatest("_ai1", "_bi1"))
    p = j.select(*[F.col(f"_a_{k}").alias(k) for k in keys], i.alias("i"), jj.alias("j")).where(F.col("j").isNotNull())
    best = p.groupBy(*keys).agg(F.min(F.struct("i", "j")).alias("_p"))
    return best.select(*keys, F.col("_p.i").alias("first_id"), F.col("_p.j").alias("second_id"))


def _runs_patterns(k: int):
    """All ways k sorted values split into runs of equal values (as run lengths)."""
    for mask in range(1 << (k - 1)):
        runs, n = [], 1
        for i in range(k - 1):
            if mask >> i & 1:
                n += 1
            else:
                runs.append(n)
                n = 1
        runs.append(n)
        yield mask, runs


def _comb(c: Column, m: int) -> Column:
    """C(c, m), exact: each step's product is divisible by its divisor."""
    big = c.cast("decimal(19,0)")
    out = big
    for i in range(1, m):
        out = F.floor(out.cast("decimal(38,0)") * (big - i).cast("decimal(19,0)") / (i + 1)).cast("decimal(38,0)")
    return out.cast("decimal(38,0)")


def multiset_count(vals: list[Column], counts: list[Column]) -> Column:
    """Number of ways to pick the sorted values vals[0] <= ... from items
    whose counts are ``counts``: the product of C(count, run length) over runs
    of equal values."""
    k = len(vals)
    expr = None
    for mask, runs in _runs_patterns(k):
        cond = None
        for i in range(k - 1):
            c = (vals[i] == vals[i + 1]) if mask >> i & 1 else (vals[i] < vals[i + 1])
            cond = c if cond is None else cond & c
        prod, pos = None, 0
        for r in runs:
            term = _comb(counts[pos], r)
            prod = term if prod is None else prod * term
            pos += r
        expr = F.when(cond if cond is not None else F.lit(True), prod) if expr is None else expr.when(cond, prod)
    return expr


def k_sum_groups(df: DataFrame, keys: Sequence[str], val: str, target, k: int = 3,
                 modulus: int = 1_000_000_007) -> DataFrame:
    """Distinct value groups v1 <= ... <= vk (k = 3 or 4) summing to target per
    key, with the number of index groups i1 < ... < ik that give them (mod
    ``modulus``).  Rows are counted per value first; 3: pairs of distinct
    values joined to the third by an equi-join on target - v1 - v2; 4: value
    pairs joined to value pairs on the complementary sum."""
    c = df.groupBy(*keys, val).agg(F.count(F.lit(1)).alias("_n"))

    def side(tag):
        return c.select(*[F.col(kk).alias(f"_{tag}_{kk}") for kk in keys], F.col(val).alias(f"v{tag}"),
                        F.col("_n").alias(f"_n{tag}"))

    if k == 3:
        one, two, three = side("1"), side("2"), side("3")
        j = (one.join(two, _keq(keys, "_1_", "_2_") + [F.col("v2") >= F.col("v1")])
             .join(three, _keq(keys, "_1_", "_3_") + [F.col("v3") == F.lit(target) - F.col("v1") - F.col("v2")])
             .where(F.col("v3") >= F.col("v2")))
    elif k == 4:
        pa = side("1").join(side("2"), _keq(keys, "_1_", "_2_") + [F.col("v2") >= F.col("v1")]) \
            .withColumn("_sa", F.col("v1") + F.col("v2"))
        pb = side("3").join(side("4"), _keq(keys, "_3_", "_4_") + [F.col("v4") >= F.col("v3")]) \
            .withColumn("_sb", F.col("v3") + F.col("v4"))
        j = pa.join(pb, _keq(keys, "_1_", "_3_") + [F.col("_sb") == F.lit(target) - F.col("_sa")]) \
            .where(F.col("v3") >= F.col("v2"))
    else:
        raise ValueError("k must be 3 or 4")
    vs = [F.col(f"v{i}") for i in range(1, k + 1)]
    cnt = multiset_count(vs, [F.col(f"_n{i}") for i in range(1, k + 1)]).cast("long")
    name = "n_triples" if k == 3 else "n_quads"
    out = j.select(*[F.col(f"_1_{kk}").alias(kk) for kk in keys], *[f"v{i}" for i in range(1, k + 1)],
                   (cnt % modulus).alias(name))
    return out.where(F.col(name) > 0)


def last_index_lookup(a: DataFrame, b: DataFrame, key: str, pos: str, name: str = "last_pos") -> DataFrame:
    """For each a-row the LAST position of its key value in b (null if absent)."""
    last = b.groupBy(key).agg(F.max(pos).alias(name))
    return a.join(last, key, "left")


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
              values: Sequence[str], prefix: str = "r_", right_seq: str | None = None,
              strict: bool = False) -> DataFrame:
    """Latest right row with ts <= left ts per key (ties: last inserted)."""
    return asof_lookup(left, right, keys, F.col(left_ts), F.col(right_ts), values,
                       direction="backward", strict=strict, right_seq=right_seq, prefix=prefix)


def nearest_join(points: DataFrame, sites: DataFrame, keys: Sequence[str], coord_p: str, coord_s: str,
                 site_id: str) -> DataFrame:
    """Nearest site per point in one dimension (tie: the lower site; equal
    sites: the highest id) and its distance."""
    s = sites.select(*keys, F.col(coord_s).alias("_sc"), F.col(site_id).alias("_sid"))
    b = asof_lookup(points, s, keys, F.col(coord_p), F.col("_sc"), ["_sc", "_sid"], "backward",
                    right_seq="_sid", prefix="_b")
    f = asof_lookup(b, s, keys, F.col(coord_p), F.col("_sc"), ["_sc", "_sid"], "forward",
                    right_seq="_sid", prefix="_f")
    db = F.col(coord_p) - F.col("_b_sc")
    dfw = F.col("_f_sc") - F.col(coord_p)
    use_b = F.col("_b_sc").isNotNull() & (F.col("_f_sc").isNull() | (db <= dfw))
    return f.select(*points.columns,
                    F.when(use_b, F.col("_b_sid")).otherwise(F.col("_f_sid")).alias(site_id),
                    F.when(use_b, db).otherwise(dfw).alias("distance"))


def covering_radius(nearest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Max over points of the distance to their nearest site, per key."""
    return nearest.groupBy(*keys).agg(F.max("distance").alias("radius"))


def _size_class(lo: Column, hi: Column, least: int) -> Column:
    """Least c with hi - lo <= 2^c and least <= 2^c: a closed span crosses at
    most one border of buckets of width 2^c."""
    length = F.greatest(F.ceil(hi - lo).cast("long"), F.lit(least).cast("long"))
    return F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1))).cast("int")


def _classes(df: DataFrame, *cols: str) -> list[list[int]]:
    """The size classes that occur in each column: at most 64 numbers."""
    return [sorted(v) for v in df.agg(*[F.collect_set(c).alias(c) for c in cols]).first()]


def _some_larger(these: list[int], than: list[int]) -> bool:
    return bool(these and than) and these[-1] > than[0]


def _bucket(x: Column, c: Column) -> Column:
    return F.call_function("shiftright", F.floor(x).cast("long"), c)


def _levels(col: str, present: list[int], above: bool) -> Column:
    """The classes of the other side from the row's own on (``above``: only larger ones)."""
    every = F.array(*[F.lit(c) for c in sorted(present)]).cast("array<int>")
    return F.filter(every, lambda c: (c > F.col(col)) if above else (c >= F.col(col)))


def interval_overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str], a_id: str, b_id: str,
                          start: str = "st", end: str = "en", width: int = 1) -> DataFrame:
    """Pairs of closed spans (same keys, null being a key of its own) that
    overlap, with the overlap length (both ends included).  Spans with a null
    end, or whose end is before their start, overlap nothing.  ``width`` is the
    least bucket width: shorter spans share one size class.

    Buckets follow each row's length: a span of size class c (length up to 2^c)
    lies in at most two buckets of width 2^c.  The longer span of a pair
    stands in the buckets of its own class; the shorter one is put into its
    (at most two) buckets of every larger class that occurs on the other side.
    Candidates of a span are thus spans no longer than itself within twice its
    length, however mixed the lengths are.  A pair is kept only in the bucket
    holding the start of its overlap, so no distinct is needed."""
    def side(df: DataFrame, tag: str, ident: str) -> DataFrame:
        return df.where(F.col(start) <= F.col(end)).select(
            *[F.col(k).alias(f"_{tag}_{k}") for k in keys], F.col(ident), F.col(start).alias(f"_{tag}s"),
            F.col(end).alias(f"_{tag}e"), _size_class(F.col(start), F.col(end), width).alias(f"_{tag}c"))

    def placed(df: DataFrame, tag: str, level: Column) -> DataFrame:
        r = df.withColumn(f"_{tag}l", level)
        return r.withColumn(f"_{tag}b", F.explode(F.sequence(_bucket(F.col(f"_{tag}s"), F.col(f"_{tag}l")),
                                                             _bucket(F.col(f"_{tag}e"), F.col(f"_{tag}l")))))

    sa, sb = reusable(side(a, "a", a_id)), reusable(side(b, "b", b_id))  # each is read three times
    (in_a,), (in_b,) = _classes(sa, "_ac"), _classes(sb, "_bc")
    same = _keq(keys, "_a_", "_b_") + [F.col("_al") == F.col("_bl"), F.col("_ab") == F.col("_bb")]
    lo, hi = F.greatest("_as", "_bs"), F.least("_ae", "_be")
    columns = [*[F.col(f"_a_{k}").alias(k) for k in keys], F.col(a_id), F.col(b_id), (hi - lo + 1).alias("overlap")]

    def pairs(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, same).where((lo <= hi) & (_bucket(lo, F.col("_al")) == F.col("_ab"))).select(columns)

    a_longer = pairs(placed(sa, "a", F.col("_ac")), placed(sb, "b", F.explode(_levels("_bc", in_a, above=False))))
    if not _some_larger(in_b, in_a):
        return a_longer
    b_longer = pairs(placed(sa, "a", F.explode(_levels("_ac", in_b, above=True))), placed(sb, "b", F.col("_bc")))
    return a_longer.unionByName(b_longer)


def box_overlap_join(boxes: DataFrame, id_col: str, x1: str, y1: str, x2: str, y2: str,
                     cell: int = 1) -> DataFrame:
    """Pairs of boxes (id_a < id_b) with positive overlap area (touching edges
    do not overlap); boxes without area or with a null side overlap nothing.
    ``cell`` is the least width of a cell.

    Cells follow each box's own sides: of size classes (cx, cy) it lies in at
    most four cells of 2^cx by 2^cy.  A pair meets in cells of the larger class
    of each axis: one box is at least as large in both (it stands in its own
    cells, the other in those of every class from its own on), or one is larger
    in x and the other in y (each stands in its own class on its larger axis).
    Each pair is kept only in the cell holding the overlap's lower-left corner."""
    base = reusable(boxes.where((F.col(x1) < F.col(x2)) & (F.col(y1) < F.col(y2))).select(
        F.col(id_col).alias("id"), F.col(x1).alias("x1"), F.col(y1).alias("y1"), F.col(x2).alias("x2"), F.col(y2).alias("y2"),
        _size_class(F.col(x1), F.col(x2), cell).alias("cx"), _size_class(F.col(y1), F.col(y2), cell).alias("cy")))
    in_x, in_y = _classes(base, "cx", "cy")

    def placed(tag: str, level_x: Column, level_y: Column) -> DataFrame:
        r = base.withColumn("lx", level_x).withColumn("ly", level_y)
        for v in "xy":
            r = r.withColumn(f"b{v}", F.explode(F.sequence(_bucket(F.col(f"{v}1"), F.col(f"l{v}")),
                                                           _bucket(F.col(f"{v}2"), F.col(f"l{v}")))))
        return r.select(*[F.col(c).alias(f"{tag}_{c}") for c in r.columns])

    own = lambda v: F.col(f"c{v}")
    up = lambda v, present, above: F.explode(_levels(f"c{v}", present, above))
    same = [F.col(f"a_{c}") == F.col(f"b_{c}") for c in ("lx", "ly", "bx", "by")]
    lx, ly = F.greatest("a_x1", "b_x1"), F.greatest("a_y1", "b_y1")
    hx, hy = F.least("a_x2", "b_x2"), F.least("a_y2", "b_y2")
    alike = (F.col("a_cx") == F.col("b_cx")) & (F.col("a_cy") == F.col("b_cy"))
    once = F.when(alike, F.col("a_id") < F.col("b_id")).otherwise(F.col("a_id") != F.col("b_id"))

    def pairs(left: DataFrame, right: DataFrame) -> DataFrame:
        # merged by cell: what a broadcast or a hash table of one task holds would grow with the table
        return left.join(right.hint("merge"), same).where(once & (lx < hx) & (ly < hy) & (_bucket(lx, F.col("a_lx")) == F.col("a_bx"))
                                            & (_bucket(ly, F.col("a_ly")) == F.col("a_by")))

    larger = pairs(placed("a", own("x"), own("y")), placed("b", up("x", in_x, False), up("y", in_y, False)))
    if _some_larger(in_x, in_x) and _some_larger(in_y, in_y):
        larger = larger.unionByName(
            pairs(placed("a", own("x"), up("y", in_y, True)), placed("b", up("x", in_x, True), own("y"))))
    area = lambda p: (F.col(f"{p}x2") - F.col(f"{p}x1")) * (F.col(f"{p}y2") - F.col(f"{p}y1"))
    ov = (hx - lx) * (hy - ly)
    return larger.select(
        F.least("a_id", "b_id").alias(f"{id_col}_a"), F.greatest("a_id", "b_id").alias(f"{id_col}_b"),
        ov.alias("overlap_area"), (area("a_") + area("b_") - ov).alias("union_area"))


def bag_overlap_join(a: DataFrame, b: DataFrame, key: str, item: str) -> DataFrame:
    """Multiset relation of the a-bag and b-bag of every key: overlap
    (sum of min counts), containment (ransom note), equality (anagram), the
    number of whole a-bags that fit in b (balloon) and the single extra item
    of b when b is a plus one item (find the difference)."""
    ca = a.groupBy(key, item).agg(F.count(F.lit(1)).alias("_ca"))
    cb = b.groupBy(key, item).agg(F.count(F.lit(1)).alias("_cb"))
    j = ca.join(cb, [key, item], "full").fillna(0, ["_ca", "_cb"])
    g = j.groupBy(key).agg(
        F.sum(F.least("_ca", "_cb")).alias("overlap"),
        F.sum("_ca").alias("a_size"), F.sum("_cb").alias("b_size"),
        F.bool_and(F.col("_ca") <= F.col("_cb")).alias("contained"),
        F.bool_and(F.col("_ca") == F.col("_cb")).alias("equal"),
        F.min(F.when(F.col("_ca") > 0, F.floor(F.col("_cb") / F.col("_ca")))).alias("fits"),
        F.min(F.when(F.col("_cb") - F.col("_ca") == 1, F.col(item))).alias("_extra"),
        F.sum(F.when(F.col("_cb") != F.col("_ca"), 1).otherwise(0)).alias("_ndiff"))
    extra = F.when((F.col("b_size") - F.col("a_size") == 1) & (F.col("_ndiff") == 1), F.col("_extra"))
    return g.select(key, "overlap", "a_size", "b_size", "contained", "equal", "fits", extra.alias("extra_item"))


def bulls_and_cows(df: DataFrame, id_col: str, secret: str, guess: str) -> DataFrame:
    """Bulls (same symbol, same place) and cows (common symbols elsewhere) per
    row, as the text ``xAyB``."""
    bulls = F.size(F.filter(F.zip_with(F.split(secret, ""), F.split(guess, ""), lambda x, y: x == y), lambda z: z))
    sym = (df.select(id_col, F.explode(F.split(secret, "")).alias("_s"), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
           .unionAll(df.select(id_col, F.explode(F.split(guess, "")).alias("_s"), F.lit(0).alias("_a"),
                               F.lit(1).alias("_b"))))
    common = (sym.groupBy(id_col, "_s").agg(F.least(F.sum("_a"), F.sum("_b")).alias("_m"))
              .groupBy(id_col).agg(F.sum("_m").alias("_common")))
    out = df.select(id_col, secret, guess, bulls.alias("bulls")).join(common, id_col, "left")
    cows = F.coalesce(F.col("_common"), F.lit(0)) - F.col("bulls")
    return out.select(id_col, secret, guess, "bulls", cows.alias("cows"),
                      F.concat(F.col("bulls").cast("string"), F.lit("A"), cows.cast("string"), F.lit("B")).alias("hint"))


def member_count_join(df: DataFrame, item: str, members: DataFrame, member: str, name: str = "n") -> DataFrame:
    """How many rows hold an item of the member set (left semi join; the
    planner broadcasts the set when its runtime size allows)."""
    return df.join(members.select(F.col(member).alias(item)), item, "left_semi").agg(F.count(F.lit(1)).alias(name))


def stopword_anti_join(tokens: DataFrame, token: str, banned: Sequence[str]) -> DataFrame:
    """Tokens minus a literal banned list (broadcast: the list is the caller's literal)."""
    spark = tokens.sparkSession
    b = spark.createDataFrame([(w,) for w in banned], f"{token} string")
    return tokens.join(F.broadcast(b), token, "left_anti")


def deletion_keys(word: Column, k: int) -> Column:
    """All strings made from ``word`` by deleting up to k characters."""
    keys = F.array(word)
    for _ in range(k):
        keys = F.array_distinct(F.flatten(F.transform(keys, lambda w: F.array_union(
            F.array(w), F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))),
                                    lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, 1 << 30)))))))
    return keys


def edit_distance_join(words: DataFrame, word: str, max_d: int = 1) -> DataFrame:
    """Distinct word pairs (w1 < w2) within Levenshtein distance max_d.

    Two words within d edits share a string of their d-deletion
    neighbourhoods, so an equi-join on those keys finds every candidate;
    ``levenshtein(l, r, d)`` verifies.  Keys are bounded by word length and d,
    not by the number of words."""
    d = words.select(F.col(word).alias("w")).where(F.col("w").isNotNull()).distinct()
    e = d.select("w", F.explode(deletion_keys(F.col("w"), max_d)).alias("key"))
    a = e.select(F.col("w").alias("w1"), F.col("key").alias("k1"), F.length("w").alias("l1"))
    b = e.select(F.col("w").alias("w2"), F.col("key").alias("k2"), F.length("w").alias("l2"))
    j = a.join(b, (F.col("k1") == F.col("k2")) & (F.col("w1") < F.col("w2"))
               & (F.abs(F.col("l1") - F.col("l2")) <= max_d))
    c = j.select("w1", "w2").distinct()
    dist = F.levenshtein("w1", "w2", max_d).cast("long")
    return c.select("w1", "w2", dist.alias("distance")).where(F.col("distance") >= 0)


def sign_code(vec: Column, bits: int = 64) -> Column:
    """64-bit code: one bit per component, set when the component is positive
    (first component in the highest bit; shifts never overflow).  A vector of
    more than ``bits`` components raises instead of losing some."""
    vec = F.when(F.size(vec) <= bits, vec).otherwise(F.raise_error(F.lit(f"sign_code: more than {bits} components")))
    flags = F.transform(F.slice(vec, 1, bits), lambda x: F.when(x > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))
    return F.aggregate(flags, F.lit(0).cast("long"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b))


def hamming_join(codes: DataFrame, id_col: str, code: str, max_d: int, bits: int = 64) -> DataFrame:
    """Pairs (id_a < id_b) of codes within Hamming distance max_d.

    The bits are cut into max_d + 1 bands: two codes within max_d differences
    agree exactly on at least one band (pigeonhole), so an equi-join on
    (band, band value) finds every candidate; a pair is kept only from the
    first band where it agrees, so no distinct is needed."""
    nb = max_d + 1
    cuts = [(i * bits) // nb for i in range(nb + 1)]  # nb disjoint bands covering all bits

    def band(x: Column, i: int) -> Column:
        lo, size = cuts[i], cuts[i + 1] - cuts[i]
        if size == 0:
            return F.lit(0).cast("long")
        mask = (1 << size) - 1 if size < 64 else -1
        if mask >= 1 << 63:
            mask -= 1 << 64
        return F.shiftright(x, lo).bitwiseAND(F.lit(mask).cast("long")) if lo else x.bitwiseAND(F.lit(mask).cast("long"))

    bands = F.array(*[F.struct(F.lit(i).alias("b"), band(F.col(code), i).alias("v")) for i in range(nb)])
    e = codes.select(F.col(id_col).alias("_id"), F.col(code).alias("_code"), F.explode(bands).alias("_band"))
    a = e.select(F.col("_id").alias("id_a"), F.col("_code").alias("ca"), F.col("_band").alias("ba"))
    b = e.select(F.col("_id").alias("id_b"), F.col("_code").alias("cb"), F.col("_band").alias("bb"))
    j = a.join(b, (F.col("ba") == F.col("bb")) & (F.col("id_a") < F.col("id_b")))
    x = F.col("ca").bitwiseXOR(F.col("cb"))
    dist = F.bit_count(x).cast("long")
    first = F.lit(True)
    for i in range(nb):
        first = first & F.when(F.col("ba.b") > i, band(x, i) != 0).otherwise(F.lit(True))
    return (j.where((dist <= max_d) & first)
            .select(F.col("id_a").alias(f"{id_col}_a"), F.col("id_b").alias(f"{id_col}_b"), dist.alias("distance")))


def prefix_lookup(words: DataFrame, word: str, probes: DataFrame, probe: str) -> DataFrame:
    """Per probe: how many words start with it and how many equal it.  Words
    are counted first; each distinct word is exploded to its prefixes of the
    lengths that probes have, then an equi-join on the prefix.  The distinct
    probes are written once, so that a small set is broadcast by its files'
    size before any prefix is shuffled."""
    p = materialize(probes.select(F.col(probe)).distinct())
    lengths = p.select(F.sort_array(F.collect_set(F.length(probe))).alias("_ls"))
    w = words.select(F.col(word).alias("_w")).where(F.length("_w") > 0).groupBy("_w").agg(F.count(F.lit(1)).alias("_n"))
    cut = F.transform(F.filter("_ls", lambda i: (i > 0) & (i <= F.length("_w"))), lambda i: F.substring("_w", F.lit(1), i))
    pre = w.crossJoin(F.broadcast(lengths)).select("_w", "_n", F.explode(cut).alias("_p"))  # one row of lengths
    hits = pre.join(p.select(F.col(probe).alias("_probe")), F.col("_p") == F.col("_probe"))
    counts = hits.groupBy("_probe").agg(F.sum("_n").alias("n_prefixed"),
                                        F.sum(F.when(F.col("_p") == F.col("_w"), F.col("_n")).otherwise(0)).alias("n_exact"))
    return p.join(counts, F.col(probe) == F.col("_probe"), "left").select(
        probe, F.coalesce("n_prefixed", F.lit(0)).alias("n_prefixed"),
        F.coalesce("n_exact", F.lit(0)).cast("long").alias("n_exact"))


def k_smallest_pairs(a: DataFrame, a_id: str, a_val: str, b: DataFrame, b_id: str, b_val: str, k: int) -> DataFrame:
    """k pairs with the least sum: the k smallest of each side (ties by id)
    are the only candidates, so the cross join is k x k rows."""
    ta = a.select(a_id, a_val).orderBy(a_val, a_id).limit(k)
    tb = b.select(b_id, b_val).orderBy(b_val, b_id).limit(k)
    s = (F.col(a_val) + F.col(b_val)).alias("total")
    return ta.crossJoin(tb).select(a_id, b_id, s).orderBy("total", a_id, b_id).limit(k)


def near_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, k: int | None,
                    t, name: str = "has_near_duplicate") -> DataFrame:
    """Per key: do two rows exist within k positions and value distance t?
    k=None: any positions; then neighbours in value order suffice (linear).
    Finite k: each row is compared with its k predecessors by one equi-join
    on (keys, row number), one side repeated at the k places after it: O(n k),
    exact."""
    if k is None:
        s = ordered_scan(df.select(*keys, val), keys, [val], [Agg("_pv", "last", F.col(val), exclusive=True)])
        g = s.groupBy(*keys).agg(F.min(F.col(val) - F.col("_pv")).alias("_mg"))
        return g.select(*keys, F.coalesce(F.col("_mg") <= t, F.lit(False)).alias(name))
    if k < 1:
        raise ValueError("near_duplicates: k counts positions from 1")
    # written once: both sides of the join read it
    r = materialize(row_index(df.select(*keys, *order, val), keys, order, name="_rn").select(*keys, "_rn", val))
    later = F.explode(F.sequence(F.col("_rn") + 1, F.col("_rn") + k))
    o = r.select(*[F.col(c).alias(f"_o_{c}") for c in keys], later.alias("_o_rn"), F.col(val).alias("_o_v"))
    m = r.join(o, _keq(keys, "", "_o_") + [F.col("_rn") == F.col("_o_rn")])
    hits = m.where(F.abs(F.col(val) - F.col("_o_v")) <= t).select(*keys)
    allk = df.select(*keys).distinct()
    found = hits.distinct().withColumn(name, F.lit(True))
    return key_join(allk, found, keys, "left").fillna(False, [name])


def collision_check(df: DataFrame, word: str, abbr: Column) -> DataFrame:
    """Each distinct word with its abbreviation and whether no OTHER word shares it."""
    d = df.select(F.col(word).alias("word")).where(F.col("word").isNotNull()).distinct() \
        .withColumn("abbr", abbr)
    n = d.groupBy("abbr").agg(F.count(F.lit(1)).alias("_n"))
    return d.join(n, "abbr").select("word", "abbr", (F.col("_n") == 1).alias("unique"))
