"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_dir

from .collocations import collocations
from .common import table
from .dac import read_documents, write_tokens
from .decontamination import find_contamination
from .exact import exact_groups
from .harmonic import pack_harmonic
from .licenses import TEMPLATES, scan_licenses
from .packing import pack
from .pii import pseudonymise_documents
from .search import search
from .simhash import near_groups
from .substrings import remove_repeats
from .toxicity import score_toxicity
from .urls import HostRule, PatternRule, judge_urls

HOST_RULES = [HostRule("allow", "com"), HostRule("block", "example.com", "/en/"),
              HostRule("allow", "www.example.com", "/en/"), HostRule("block", "net", "/es/"),
              HostRule("block", "net", "/fr/")]
PATTERN_RULES = [PatternRule("block", "spam-farm"), PatternRule("block", "cheap-pills"),
                 PatternRule("block", "casino-win"), PatternRule("block", "utm_source=*&ref=*"),
                 PatternRule("block", "/login/"), PatternRule("block", "/wp-admin/")]

#: The key of the registered query alone; a deployment passes its own secret.
PSEUDONYM_KEY = b"registered query, not a secret"

PACK_CAPACITY, PACK_END_ID = 4096, 1
HARMONIC_END_ID = 2
SEARCH_TOP = 10
PHRASE_LEAST, PHRASE_TOP = 100, 2000
NEAR_SHINGLE, NEAR_BITS = 4, 4


def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"),
                 kind="space_led", end_id=0)
    return read_documents(spark, path)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), HOST_RULES, PATTERN_RULES, plain=True)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise_documents(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("n_bytes")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), kind="space_free",
                capacity=PACK_CAPACITY, end_id=PACK_END_ID)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (near_groups(table(spark, sf_dir, "documents"), NEAR_SHINGLE, NEAR_BITS)
            .select("doc_id", "fingerprint", "component_id"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "item_id", "similarity"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), PHRASE_LEAST, PHRASE_TOP)


def op12_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_harmonic(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                         kind="space_free", capacity=PACK_CAPACITY, end_id=HARMONIC_END_ID)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=SEARCH_TOP)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_file, op2_url_filter, op3_pii, op4_repeated_bytes, op5_exact_dedup, op6_license_scan,
                            op7_toxicity, op8_packing, op9_simhash, op10_decontamination, op11_collocations, op12_harmonic_packing,
                            op13_ranked_search)}

# --- DuckDB equivalents, where SQL can express an operator on whole tables ---

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _fits(rule: HostRule) -> str:
    return (f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}')")


def _matches(rule: PatternRule) -> str:
    return f"regexp_matches(low, '{rule.pattern.replace('*', '.*')}', 's')"


def _op2_sql() -> str:
    hosts = sorted(HOST_RULES, key=lambda r: -len(r.text))
    patterns = sorted(PATTERN_RULES, key=lambda r: (-len(r.pattern), r.pattern))
    case = lambda rules, test, value, end: (
        "CASE " + " ".join(f"WHEN {test(r)} THEN '{value(r)}'" for r in rules) + f" ELSE {end} END")
    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), {_LOWER}) AS low,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {_LOWER}) AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
ruled AS (SELECT *, {case(hosts, _fits, lambda r: r.text, 'NULL')} AS rule,
                 {case(hosts, _fits, lambda r: r.action, 'NULL')} AS action,
                 {case(patterns, _matches, lambda r: r.pattern, 'NULL')} AS pattern FROM parts)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN pattern IS NOT NULL THEN 'block' END, 'allow') AS verdict, pattern FROM ruled"""


_OP5_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW same AS (PARTITION BY t)"""

_WORDS = (r"list_filter(regexp_split_to_array(translate(coalesce({0}, ''), " + _LOWER
          + r"), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")


def _op6_sql() -> str:
    """Every place of every key phrase, by looking at all places."""
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    starts = lambda t: (f"list_filter(range(0, greatest(len(w) - {len(t.key) - 1}, 0)), "  # noqa: E731
                        f"lambda i: w[i + 1:i + {len(t.key)}] = {listed(t.key)})")
    places = ", ".join(f"{starts(t)} AS v{k}" for k, t in enumerate(TEMPLATES))
    base = " || ".join(f"v{k}" for k, t in enumerate(TEMPLATES) if t.base)
    labels = lambda some: ("array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(
        f"CASE WHEN len(v{k}) > 0 THEN '{t.label}' END" for k, t in some) + "], lambda x: x IS NOT NULL))), ',')")
    shares = []
    for k, t in enumerate(TEMPLATES):
        here = " + ".join(f"CASE WHEN s + {j - t.key_at} >= 0 AND w[s + {j - t.key_at + 1}] = '{x}' THEN 1 ELSE 0 END"
                          for j, x in enumerate(t.words))
        shares.append(f"coalesce(list_max(list_transform(v{k}, lambda s: {here})) / {len(t.words)}::DOUBLE, 0)")
    pairs = list(enumerate(TEMPLATES))
    return f"""
WITH words AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
found AS (SELECT *, {places} FROM words),
based AS (SELECT *, {base} AS b FROM found)
SELECT doc_id, len(w) AS n_words, len(b) AS n_base, list_min(b) AS first_word, list_max(b) AS last_word,
       {labels([p for p in pairs if p[1].base])} AS base_labels, {labels(pairs)} AS labels,
       greatest({', '.join(shares)}) AS score
FROM based"""


_SHINGLES = ("CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: "
             "array_to_string(w[i:i + 4], ' ')) "
             "WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END")

_OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, {_SHINGLES} AS hs
           FROM (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents)),
b AS (SELECT item_id, {_SHINGLES} AS ihs FROM (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark)),
dh AS (SELECT row_no, unnest(hs) AS h, unnest(range(0, len(hs))) AS p FROM d),
bh AS (SELECT DISTINCT item_id, unnest(ihs) AS h FROM b),
hit AS (SELECT DISTINCT row_no, item_id, p FROM dh JOIN bh USING (h)),
starts AS (SELECT DISTINCT row_no, d.doc_id, b.item_id, least(p, greatest(len(hs) - len(ihs), 0)) AS s, hs, ihs
           FROM hit JOIN d USING (row_no) JOIN b USING (item_id)),
win AS (SELECT row_no, doc_id, item_id, ihs, hs[s + 1:s + len(ihs)] AS win FROM starts),
scored AS (SELECT *, list_sum(list_transform(list_distinct(ihs), lambda h: least(
             len(list_filter(win, lambda x: x = h)), len(list_filter(ihs, lambda x: x = h))))) AS m FROM win)
SELECT any_value(doc_id) AS doc_id, item_id, max(m / (len(win) + len(ihs) - m)::DOUBLE) AS similarity
FROM scored GROUP BY row_no, item_id HAVING similarity >= 0.8"""

_TERMS = r"regexp_extract_all(translate(coalesce({0}, ''), " + _LOWER + r"), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, {_TERMS.format('text')} AS w FROM documents),
c AS (SELECT count(*) FILTER (len(w) > 0) AS nd, coalesce(sum(len(w)), 0)::BIGINT AS nt FROM d),
i AS (SELECT row_number() OVER () AS item_no, item_id, unnest(list_distinct({_TERMS.format('text')})) AS t FROM benchmark),
p AS (SELECT row_no, t, count(*) AS tf FROM (SELECT row_no, unnest(w) AS t FROM d) GROUP BY ALL),
f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
s AS (SELECT item_no, any_value(item_id) AS item_id, row_no, any_value(doc_id) AS doc_id,
             sum(floor(1000 * ln((2 * nd + 2) / (2 * df + 1)))::BIGINT
                 * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * len(w) * nd) // nt)))))::BIGINT AS score
      FROM i JOIN p USING (t) JOIN f USING (t) JOIN d USING (row_no), c GROUP BY item_no, row_no)
SELECT item_id, (row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10"""

_OP11_SQL = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}),
                  '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, range(1, 6) r(k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {PHRASE_LEAST}),
cut AS (SELECT lang, phrase, f AS a, w, unnest(range(1, k)) AS c FROM c),
s AS (SELECT cut.lang, cut.phrase, c, a, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:c], ' ')
      JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[c + 1:], ' ') JOIN n ON n.lang = cut.lang),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
longer AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS most
           FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       score::BIGINT AS score
FROM low LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a QUALIFY rank <= {PHRASE_TOP}"""

ORACLE: dict[str, str] = {"op2_url_filter": _op2_sql(), "op5_exact_dedup": _OP5_SQL, "op6_license_scan": _op6_sql(),
                          "op10_decontamination": _OP10_SQL, "op11_collocations": _OP11_SQL,
                          "op13_ranked_search": _OP13_SQL}
