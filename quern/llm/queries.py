"""The operators bound to the driver's tables: one query each, with DuckDB SQL
where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, quality_gam
from .collocation import collocations
from .common import read
from .contamination import contamination
from .license_scan import PHRASES, TEMPLATES, scan
from .line_dedup import dedup_lines
from .mixing import mix
from .quality_rules import BOILERPLATE, NAVIGATION, SYMBOLS, quality
from .secret_scan import secrets
from .simhash import components
from .sketch import fingerprint_pairs
from .spelling import variants
from .url_filter import filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op2_source_mix", rf"""
WITH sizes AS (SELECT doc_id, source, len({WORDS_SQL})::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM per),
weighed AS (SELECT source, source_size, 2 * source_size AS cap, [3, 1, 2][(place % 3 + 1)::INT] AS w FROM placed),
ratios AS (SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS r FROM weighed),
heads AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS used,
                 sum(w) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS open,
                 (SELECT sum(size) FROM sizes)::BIGINT AS total FROM ratios),
levels AS (SELECT *, (1.5::DOUBLE * total - used) / open AS level FROM heads),
chosen AS (SELECT level FROM levels WHERE NOT (cap < level * w) ORDER BY r LIMIT 1),
targets AS (SELECT source, source_size, least(cap::DOUBLE, (SELECT level FROM chosen) * w) AS target FROM weighed),
steps AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216)::BIGINT ELSE 0 END AS step,
                 ('0x' || substr(md5('mix-1:' || coalesce(source, '')), 1, 6))::BIGINT AS shift FROM targets),
ranks AS (SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY size, md5(coalesce(doc_id::VARCHAR, ''))) AS place FROM sizes)
SELECT doc_id, size, source_size, target,
       (((place * step + shift) >> 24) - (((place - 1) * step + shift) >> 24)) * size AS taken
FROM ranks JOIN steps ON ranks.source IS NOT DISTINCT FROM steps.source
""")
def op2_source_mix(spark, sf_dir):
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_url_rules", r"""
WITH rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
cut AS (SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0
                             THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
parsed AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path, row_number() OVER () AS rid FROM parts),
hits AS (SELECT rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
         FROM parsed JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parsed LEFT JOIN hits USING (rid)
""")
def op9_url_rules(spark, sf_dir):
    return filter_urls(read(spark, sf_dir, "pages"))


_LINE_SYMBOLS = SYMBOLS + "!{}=_~^\\"


@query("op6_line_quality", rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n_repeat FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d),
judged AS (SELECT rid, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n,
                  length(x) - length(translate(x, '{_LINE_SYMBOLS}', '')) AS symbols,
                  length(regexp_replace(x, '[^\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(x, '[^\p{{Lu}}]', '', 'g')) AS capitals,
                  len(list_distinct(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) AS uniq FROM lines),
per AS (SELECT rid, sum(CASE WHEN symbols * 10 > length(x) OR (letters >= 20 AND capitals * 10 > letters * 6)
                               OR (n >= 10 AND uniq * 100 < n * 30) OR regexp_matches(x, '{NAVIGATION}')
                               OR regexp_matches(x, '{BOILERPLATE}') THEN n ELSE 0 END) AS lost,
               count(*) FILTER (n > 0) - count(DISTINCT x) FILTER (n > 0) AS n_dup FROM judged GROUP BY rid),
r AS (SELECT doc_id, len(ws) AS n_words, length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
             length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols, n_dup AS n_dup_lines,
             coalesce(n_repeat, 0) AS n_repeat_words, lost FROM w JOIN per USING (rid) LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost <= n_words * 0.3::DOUBLE AS kept FROM f
""")
def op6_line_quality(spark, sf_dir):
    return quality(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark, sf_dir):
    return components(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)


_PHRASE_ROWS = ", ".join(f"('{p}', '{label}')" for p, label in PHRASES)
_TEMPLATE_ROWS = ", ".join(f"({i}, '{label}', '{body}')" for i, (label, body) in enumerate(TEMPLATES))
_LOWER_WORDS = r"regexp_extract_all(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op5_license_scan", f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, {_LOWER_WORDS.format(x='t')} AS ws FROM d),
phrases(phrase, label) AS (VALUES {_PHRASE_ROWS}),
p AS (SELECT string_split(phrase, ' ') AS ps, label FROM phrases),
places AS (SELECT rid, i - 1 AS i, label FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM w) x
       JOIN p ON ws[i] = ps[1] AND ws[i:i + len(ps) - 1] = ps),
base AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY rid),
templates(k, label, body) AS (VALUES {_TEMPLATE_ROWS}),
t AS (SELECT k, label, list_distinct(string_split(body, ' ')) AS ts FROM templates),
lines AS (SELECT rid, {_LOWER_WORDS.format(x='line')} AS lw FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)),
m AS (SELECT rid, label, len(list_intersect(ts, lw)) AS held, len(ts) AS n FROM lines JOIN t ON list_has_any(lw, ts)),
more AS (SELECT rid, list(DISTINCT label) AS labels, max(held::DOUBLE / n) AS held FROM m WHERE held >= ceil(0.8::DOUBLE * n - 1e-9) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(coalesce(base.labels, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
       greatest(CASE WHEN coalesce(n_base, 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, coalesce(more.held, 0.0::DOUBLE)) AS score
FROM w LEFT JOIN base USING (rid) LEFT JOIN more USING (rid)
""")
def op5_license_scan(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents"))


@query("op7_scaled_sketch")
def op7_scaled_sketch(spark, sf_dir):
    return fingerprint_pairs(read(spark, sf_dir, "documents"), scale=2)


@query("op10_line_dedup")
def op10_line_dedup(spark, sf_dir):
    return dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "_dedup.n_lines", "_dedup.n_removed", "text")


@query("op3_secret_ledger")
def op3_secret_ledger(spark, sf_dir):
    return secrets(read(spark, sf_dir, "documents"))


@query("op8_quality_gam")
def op8_quality_gam(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = quality_gam.train(docs, read(spark, sf_dir, "labels"))
    return quality_gam.score(docs, model).withColumn("predicted", (F.col("score") >= quality_gam.THRESHOLD).cast("int"))


@query("op4_bpe_prefix_dp")
def op4_bpe_prefix_dp(spark, sf_dir):
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.encode(read(spark, sf_dir, "documents"), path), path)


_ITEM_WINDOW = 10


@query("op11_benchmark_join", f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_LOWER_WORDS.format(x="coalesce(text, '')")} AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_LOWER_WORDS.format(x="coalesce(text, '')")} AS ws FROM benchmark),
listed AS (SELECT DISTINCT item, array_to_string(ws[i:i + least({_ITEM_WINDOW}, len(ws)) - 1], ' ') AS phrase, least({_ITEM_WINDOW}, len(ws)) AS n
           FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - {_ITEM_WINDOW} + 1, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM listed),
spots AS (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
places AS (SELECT rid, i, n, phrase FROM (SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS phrase FROM spots JOIN sizes ON i + n - 1 <= len(ws))
           WHERE (phrase, n) IN (SELECT phrase, n FROM listed)),
hit AS (SELECT rid, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM places) GROUP BY rid),
held AS (SELECT rid, list_sort(list(DISTINCT item)) AS items FROM places JOIN listed USING (phrase) WHERE item IS NOT NULL GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, len(coalesce(items, [])) AS n_items,
       sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN held USING (rid)
""")
def op11_benchmark_join(spark, sf_dir):
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=_ITEM_WINDOW)


@query("op12_collocations", r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
spots AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
grams AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM spots JOIN (VALUES (1), (2), (3)) AS s(k) ON i + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS n FROM grams GROUP BY lang, k, phrase),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
inner2 AS (SELECT lang, p, max(a) AS longer FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS p FROM c WHERE k = 3)
           GROUP BY lang, p),
kept AS (SELECT c.* FROM c LEFT JOIN inner2 ON c.lang = inner2.lang AND c.phrase = p WHERE k = 3 OR longer IS NULL OR 100 * longer < 50 * a),
cuts AS (SELECT lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS lp, array_to_string(ws[cut + 1:k], ' ') AS rp
         FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept)),
scored AS (SELECT cuts.*, fl.n AS l, fr.n AS r, ((1000000::HUGEINT * a * a) // (fl.n::HUGEINT * fr.n))::BIGINT AS score
           FROM cuts JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = lp JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = rp),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, total.n AS n, score
FROM low JOIN total USING (lang) QUALIFY rank <= 2000
""")
def op12_collocations(spark, sf_dir):
    return collocations(read(spark, sf_dir, "documents"), max_words=3, min_count=10, cover=50, top=2000)


@query("op13_spelling_variants")
def op13_spelling_variants(spark, sf_dir):
    return variants(read(spark, sf_dir, "documents"), min_len=7, min_count=2, noise=31, ratio=10)
