"""The operators as queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiretide.llm import (byte_bpe, fingerprints, html_text, licenses, line_dedup, merkle, ngram_join,
                          packing, pii, quality, resampling, token_counts, url_filter)
from hiretide.llm.common import documents, stored


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_pii(documents(spark, sf_dir))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts as they are left, and how many lines went."""
    return line_dedup.dedup_lines(documents(spark, sf_dir), count_col="n_removed").select(
        "doc_id", "n_removed", "text")


OP3_SQL = r"""
WITH texts AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM texts),
solid AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM lines
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
pairs AS (SELECT s.doc_id, i, j, array_to_string(lines[i:j], chr(10)) AS pair
          FROM solid s JOIN texts t ON s.doc_id = t.doc_id WHERE j IS NOT NULL),
later AS (SELECT doc_id, i, j FROM pairs QUALIFY row_number() OVER (PARTITION BY pair ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i FROM later),
rest AS (SELECT l.doc_id, count(g.i) AS n,
                coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text
         FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(r.n, 0) AS n_removed, CASE WHEN r.n > 0 THEN r.text ELSE d.text END AS text
FROM documents d LEFT JOIN rest r ON d.doc_id = r.doc_id
"""


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir))


BLANK = r"\x20\x09-\x0D"
OP4_SQL = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^{BLANK}]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {ngram_join.SHINGLE}
    THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(
      range(1, len(w) - {ngram_join.SHINGLE} + 2),
      lambda i: array_to_string(w[i:i + {ngram_join.SHINGLE} - 1], ' '))) END AS s
  FROM worded),
shingles AS (SELECT doc_id, unnest(s) AS s FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
           FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sets x ON a = x.doc_id JOIN sets y ON b = y.doc_id
          WHERE 100 * n >= {ngram_join.PERCENT} * (len(x.s) + len(y.s) - n)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION SELECT r.doc_id, s.b FROM reached r JOIN steps s ON r.other = s.a)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reached r ON s.doc_id = r.doc_id GROUP BY ALL
"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir),
                                  public_tokenizers.path("word_bpe_49k.json"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints.edit_likeness(documents(spark, sf_dir))
    digits = ("edited_sha256", "fingerprint", "edited_fingerprint")  # stored and joined as bytes
    prints = stored(prints.withColumns({c: F.unhex(c) for c in digits}), "prints")
    return fingerprints.with_neighbours(prints).withColumns({c: F.lower(F.hex(c)) for c in digits})


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(documents(spark, sf_dir),
                           public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir),
                                     public_tokenizers.path("byte_bpe_50k.json"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: pieces like a licence template, their licences, and the best likeness."""
    found = F.col("found")
    return licenses.find_licenses(documents(spark, sf_dir)).select(
        "doc_id", F.size(found).cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(found["license"])), ",").alias("licenses"),
        F.coalesce(F.array_max(found["dice"]), F.lit(0.0)).alias("best_dice"))


def _license_sql() -> str:
    values = ",\n  ".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')"
                          for i, (name, text) in enumerate(licenses.TEMPLATES))
    words = ("list_filter(string_split(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')")
    grams = ("list_distinct(list_transform(range(1, len(words)), "
             "lambda i: words[i] || ' ' || words[i + 1]))")
    t = licenses.LEAST_PCT
    return rf"""
WITH templates(t, license, text) AS (VALUES {values}),
tgrams AS (SELECT t, license, {grams} AS g FROM (
    SELECT t, license, {words.format('text')} AS words FROM templates)),
parts AS (
    SELECT doc_id, 'line' AS kind, unnest(string_split(text, chr(10))) AS part,
           generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents
    UNION ALL SELECT * FROM (
        SELECT doc_id, 'paragraph' AS kind,
               unnest(regexp_split_to_array(text, '
[ 	
]*
')) AS part,
               generate_subscripts(regexp_split_to_array(text, '
[ 	
]*
'), 1) AS i
        FROM documents) WHERE contains(part, chr(10))),
worded AS (SELECT doc_id, kind, i, {words.format('part')} AS words FROM parts),
grams AS (SELECT doc_id, kind, i, {grams} AS g FROM worded WHERE len(words) > 1),
scored AS (SELECT doc_id, kind, i, license,
                  2.0::DOUBLE * len(list_intersect(p.g, q.g)) / (len(p.g) + len(q.g)) AS dice
           FROM grams p JOIN tgrams q
           ON least(len(p.g), len(q.g)) * {200 - t} >= greatest(len(p.g), len(q.g)) * {t}),
best AS (SELECT doc_id, kind, i, max(dice) AS dice, max(license) AS license FROM (
             SELECT *, dice = max(dice) OVER (PARTITION BY doc_id, kind, i) AS top FROM scored)
         WHERE top AND 100 * dice >= {t} GROUP BY doc_id, kind, i)
SELECT d.doc_id, count(b.i) AS n_notices,
       coalesce(string_agg(DISTINCT b.license, ',' ORDER BY b.license), '') AS licenses,
       coalesce(max(b.dice), 0.0::DOUBLE) AS best_dice
FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id GROUP BY d.doc_id
"""


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "failed_on")


def _quality_sql() -> str:
    """The counts, the quartiles of each language and source leaning on the language's, and the fences."""
    kind = "[^{0}]"
    count = lambda chars: f"length(regexp_replace(t, '{kind.format(chars)}', '', 'g'))"
    share = lambda part, whole: f"CASE WHEN {whole} > 0 THEN {part} / {whole} ELSE 0.0::DOUBLE END"
    shares = {m: (part, whole) for m, (part, whole, _, _) in quality.MEASURES.items()}
    sketches = ", ".join(f"quantile_disc({m}, [0.25, 0.5, 0.75]) AS {m}_q" for m in shares)
    leaning = lambda m, i: (f"((o.n * o.{m}_q[{i}] + {quality.LEAN} * w.{m}_q[{i}]) / (o.n + {quality.LEAN}))")
    reach = f"{quality.FENCE / quality.QUARTILE!r}::DOUBLE"
    bounds, failed = [], []
    for m, (_, whole, below, above) in quality.MEASURES.items():
        low, middle, high = (leaning(m, i) for i in (1, 2, 3))
        if below:
            bounds.append(f"{middle} - ({middle} - {low}) * {reach} AS {m}_low")
            failed.append((m, "low", f"{m} < {m}_low - {{}}", whole))
        if above:
            bounds.append(f"greatest({middle} + ({high} - {middle}) * {reach}, "
                          f"{quality.FLOORS.get(m, 0.0)}::DOUBLE) AS {m}_high")
            failed.append((m, "high", f"{m} > {m}_high + {{}}", whole))
    failed = [f"CASE WHEN {w} > 0 AND {test.format(f'{quality.CHANCE}::DOUBLE * sqrt(greatest({m}_{side}, 0) / {w})')} "
              f"THEN '{m}_{side}' END" for m, side, test, w in failed]
    n = quality.WINDOW
    return rf"""
WITH texts AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^{BLANK}]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^{BLANK}]')) AS lines FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + {n - 1}], ' ') AS words
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM texts)),
twice AS (SELECT doc_id, i FROM windows
          QUALIFY count(*) OVER (PARTITION BY doc_id, words) > 1),
inside AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
             SELECT doc_id, unnest(range(i, i + {n})) AS p FROM twice) GROUP BY doc_id),
counts AS (
  SELECT x.doc_id, lang, source, len(w) AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    {count("#*$%&|<>")} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes,
    {count("!?")} AS n_marks, {count("A-Z")} AS n_upper, {count("A-Za-z")} AS n_cased
  FROM texts x LEFT JOIN inside i ON x.doc_id = i.doc_id),
measured AS (SELECT *, n_words < {quality.LEAST_WORDS}
    OR 100 * n_repeat_words > {quality.MOST_REPEATED_PCT} * n_words AS base_failed,
    {", ".join(f"{share(*parts)} AS {name}" for name, parts in shares.items())} FROM counts),
own AS (SELECT lang, source, count(*) AS n, {sketches} FROM measured GROUP BY lang, source),
wide AS (SELECT lang, {sketches} FROM measured GROUP BY lang),
limits AS (SELECT o.lang, o.source, {", ".join(bounds)} FROM own o JOIN wide w ON o.lang IS NOT DISTINCT FROM w.lang),
judged AS (SELECT m.*, list_filter([{", ".join(failed)}], lambda x: x IS NOT NULL) AS failed
  FROM measured m JOIN limits l ON m.lang IS NOT DISTINCT FROM l.lang
    AND m.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND len(failed) = 0 AS kept, array_to_string(failed, ',') AS failed_on FROM judged
"""


#: CRC-32 of a text, byte by byte, by a table that is made by its rule: ``crc.t``.
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda x: list_reduce(
    list_prepend(x, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc_sql(text: str) -> str:
    """The CRC-32 of ``text``, where ``crc`` is joined."""
    octets = (f"list_transform(range(strlen({text})), "
              f"lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents resampled towards the texts of ``benchmark``."""
    return resampling.resample(documents(spark, sf_dir),
                               spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _resampling_sql() -> str:
    r = resampling
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH {CRC_TABLE},
texts AS (SELECT 'd' AS kind, doc_id, text FROM documents
          UNION ALL SELECT 'b', item_id, text FROM benchmark),
worded AS (SELECT kind, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}') AS w FROM texts),
features AS (SELECT kind, doc_id, unnest(w) AS f FROM worded
  UNION ALL SELECT kind, doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
  FROM worded),
counted AS (SELECT kind, doc_id, f, count(*) AS n FROM features GROUP BY ALL),
buckets AS (SELECT f, {_crc_sql('f')} % {r.BUCKETS} AS bucket
            FROM (SELECT DISTINCT f FROM counted), crc),
placed AS (SELECT kind, doc_id, bucket, n FROM counted JOIN buckets USING (f)),
totals AS (SELECT coalesce(sum(n) FILTER (kind = 'd'), 0) + {r.BUCKETS} AS s_all,
                  coalesce(sum(n) FILTER (kind = 'b'), 0) + {r.BUCKETS} AS t_all FROM placed),
gains AS (SELECT bucket, floor(1000 * ln(((t + 1) * s_all)::DOUBLE / ((s + 1) * t_all)::DOUBLE))::BIGINT AS gain
  FROM (SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0) AS s,
               coalesce(sum(n) FILTER (kind = 'b'), 0) AS t FROM placed GROUP BY bucket), totals),
weighed AS (SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain) AS total
            FROM placed JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY doc_id),
scored AS (SELECT x.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(
    (total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('{r.SEED}:' || x.doc_id), 1, 8))::BIGINT AS h
  FROM worded x LEFT JOIN weighed y ON x.doc_id = y.doc_id WHERE kind = 'd'),
summed AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM summed
           WHERE n_words >= {r.LEAST_WORDS})
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= {r.DRAWN_PCT} * (
  SELECT count(*) FROM ranked) // 100 THEN rank END AS rank
FROM summed s LEFT JOIN ranked r ON s.doc_id = r.doc_id
"""


LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's proof, checked against rows of which half have lost their line ends."""
    docs = documents(spark, sf_dir)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    claimed = F.when(changed, merkle.leaf_hash([text if c == "text" else F.col(c) for c in LEAF_COLUMNS]))
    return merkle.manifest(docs, LEAF_COLUMNS, claimed=claimed).verified().withColumnRenamed("id", "doc_id")


def _merkle_sql() -> str:
    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(
            f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')"
            for c in (text if c == "text" else c for c in LEAF_COLUMNS)) + ")"

    def tree(name: str, leaves: str) -> str:
        return f"""{name} AS (
  SELECT tree, 0 AS level, i, n, d FROM {leaves}
  UNION ALL SELECT tree, level + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(d, '' ORDER BY i))
  FROM {name} WHERE n > 1 GROUP BY tree, level, i // 3)"""

    def steps(own: str, name: str, level: str) -> str:
        return f"""SELECT x.doc_id, {level} AS step,
    coalesce(string_agg(u.d, '' ORDER BY u.i) FILTER (u.i < x.{own} // (3 ** u.level)::BIGINT), '') AS l,
    coalesce(string_agg(u.d, '' ORDER BY u.i) FILTER (u.i > x.{own} // (3 ** u.level)::BIGINT), '') AS r
  FROM placed x JOIN {name} u ON x.{name}_tree = u.tree AND u.n > 1
    AND u.i // 3 = x.{own} // (3 ** u.level)::BIGINT // 3 GROUP BY x.doc_id, {level}"""

    return rf"""
WITH RECURSIVE {CRC_TABLE},
rows AS (SELECT doc_id, coalesce('1' || source, '0') AS tree, {leaf('text')} AS d,
    CASE WHEN {_crc_sql('doc_id::VARCHAR')} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} END AS changed
  FROM documents, crc),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS i,
                  count(*) OVER (PARTITION BY tree) AS n FROM rows),
{tree('low', 'leaves')},
subroots AS (SELECT tree AS source, d, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i,
                    count(*) OVER () AS n FROM low WHERE n = 1),
{tree('high', 'subroots')},
placed AS (SELECT l.*, l.tree AS low_tree, s.tree AS high_tree, s.i AS j, s.d AS subroot
           FROM leaves l JOIN subroots s ON l.tree = s.source),
steps AS ({steps('i', 'low', 'u.level')} UNION ALL {steps('j', 'high', '100 + u.level')}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY step) - 1 AS k FROM steps),
folds AS (SELECT doc_id, 0 AS k, coalesce(changed, d) AS d FROM placed
  UNION ALL SELECT f.doc_id, f.k + 1, sha256(l || d || r) FROM folds f JOIN numbered s
  ON f.doc_id = s.doc_id AND f.k = s.k)
SELECT p.doc_id, p.d AS leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM placed p LEFT JOIN (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256
                         FROM steps GROUP BY doc_id) q ON p.doc_id = q.doc_id
JOIN (SELECT doc_id, arg_max(d, k) AS folded_root FROM folds GROUP BY doc_id) f ON p.doc_id = f.doc_id,
(SELECT d AS root FROM high WHERE n = 1)
"""


#: Names of hosts whose URLs op13 lists.
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL under the rules and a list of the URLs on hosts of a listed name."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    names = F.split(url_filter.host_of(F.col("url")), r"\.", -1)
    listed = pages.filter(F.arrays_overlap(names, F.array(*map(F.lit, LISTED_NAMES)))).select("url")
    return url_filter.judge_urls(pages, listed)


def _url_sql() -> str:
    u = url_filter
    names = ", ".join(f"'{n}'" for n in LISTED_NAMES)
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in u.RULES)
    tracking = f"^({'|'.join(u.TRACKING)})(=|$)"
    return rf"""
WITH parts AS (SELECT page_id, url, contains(coalesce(url, ''), '://') AS whole,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    array_to_string(list_sort(list_filter(string_split(
      regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '{tracking}'))), '&') AS query FROM pages),
plain AS (SELECT *, CASE WHEN whole THEN
    regexp_replace(regexp_replace(host, '\.?(:80|:443)?$', ''), '^www\.', '')
    || regexp_replace(regexp_replace(path, '(index)?\.html?$', ''), '/+$', '')
    || CASE WHEN query <> '' THEN '?' || query ELSE '' END ELSE '' END AS canonical FROM parts),
listed AS (SELECT DISTINCT canonical FROM plain
           WHERE canonical <> '' AND list_has_any(string_split(host, '.'), [{names}])),
rules AS (SELECT * FROM (VALUES {rules}) AS r(h, p, v)),
fits AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM plain JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT a.page_id, host, path, rule, coalesce(verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block'
       ELSE 'allow' END) AS verdict, l.canonical IS NOT NULL AS listed
FROM plain a LEFT JOIN fits f ON a.page_id = f.page_id LEFT JOIN listed l ON a.canonical = l.canonical
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pii, op2_html_extraction, op3_line_dedup, op4_ngram_jaccard_join,
        op5_packing, op6_document_fingerprints,
        op7_byte_bpe, op8_token_counts, op9_license_scans, op10_quality_rules,
        op11_importance_resampling, op12_merkle_manifest, op13_url_filter)}
ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": OP3_SQL, "op4_ngram_jaccard_join": OP4_SQL,
    "op9_license_scans": _license_sql(), "op10_quality_rules": _quality_sql(),
    "op11_importance_resampling": _resampling_sql(), "op12_merkle_manifest": _merkle_sql(),
    "op13_url_filter": _url_sql()}
