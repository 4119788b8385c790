"""Registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.llm import (
    chat,
    katz,
    licenses,
    mixing,
    neighbours,
    oddsketch,
    packing,
    positions,
    secrets,
    simhash,
    sketches,
    toxicity,
    whitening,
)
from sentinela.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    """Register a function under its name, with its checking SQL if there is one."""

    def register(make: Callable[[SparkSession, str], DataFrame]):
        QUERIES[make.__name__] = make
        if check is not None:
            CHECKS[make.__name__] = check
        return make

    return register


@query()
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


# The digests follow from the table alone. Escaping adds one backslash for each control string, with
# or without backslashes of its own, in turns that have any.
CHAT_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
  SELECT *, regexp_replace(role || chr(10) || text, '([<\[])(\\*/?(s>|INST\]))', '\1\\\2', 'g') AS escaped FROM given)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length(escaped) - 1 + length('<s>[INST] ') + length(' [/INST]') + length('</s>')) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query(CHAT_SQL)
def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.read_back(chat.format_turns(chat.with_probe(table(spark, folder, "conversations"))))


def license_sql(templates: tuple = licenses.TEMPLATES, threshold: float = licenses.THRESHOLD) -> str:
    """Every line against every template, without filters."""
    rows = []
    for number, (label, members) in enumerate(licenses.template_sets(templates)):
        listed = ", ".join(f"'{word}'" for word in members)
        rows.append(f"({number}, '{label}', [{listed}], {len(members)}, {licenses.least_overlap(len(members), threshold)})")

    def words(text: str) -> str:
        return rf"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

    return f"""
WITH templates(number, label, words, size, need) AS (VALUES {", ".join(rows)}),
lowered AS (
  SELECT row_number() OVER () AS row, doc_id,
    translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}') AS low
  FROM documents),
counted AS (SELECT row, doc_id, low, {words("low")} AS words FROM lowered),
numbered AS (SELECT row, unnest(words) AS word, unnest(range(len(words))) AS spot FROM counted WHERE low LIKE '%license%'),
following AS (
  SELECT row, spot, word, lead(word) OVER w AS second, lead(word, 2) OVER w AS third
  FROM numbered WINDOW w AS (PARTITION BY row ORDER BY spot)),
places AS (
  SELECT row, spot, CASE WHEN word = 'mit' AND second = 'license' THEN 'mit' WHEN word = 'apache' AND second = 'license' THEN 'apache'
    WHEN word = 'general' AND second = 'public' AND third = 'license' THEN 'gpl' END AS label
  FROM following),
base AS (
  SELECT row, count(*) AS n, min(spot) AS first_word, max(spot) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places WHERE label IS NOT NULL GROUP BY row),
lines AS (SELECT row, unnest(string_split(low, chr(10))) AS line FROM counted),
line_words AS (SELECT row, {words("line")} AS words FROM lines),
matches AS (
  SELECT l.row, t.label, CAST(len(list_intersect(t.words, l.words)) AS DOUBLE) / t.size AS containment
  FROM line_words l JOIN templates t ON len(l.words) >= t.need AND len(list_intersect(t.words, l.words)) >= t.need),
best AS (SELECT row, max(containment) AS best FROM matches GROUP BY row),
every_label AS (
  SELECT row, label FROM matches UNION SELECT row, label FROM places WHERE label IS NOT NULL),
named AS (SELECT row, string_agg(label, ',' ORDER BY label) AS labels FROM every_label GROUP BY row)
SELECT c.doc_id, CAST(len(c.words) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
  CAST(b.first_word AS BIGINT) AS first_word, CAST(b.last_word AS BIGINT) AS last_word,
  coalesce(b.labels, '') AS base_labels, coalesce(n.labels, '') AS labels,
  CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.best, 0.0::DOUBLE) END AS score
FROM counted c LEFT JOIN base b USING (row) LEFT JOIN named n USING (row) LEFT JOIN best USING (row)
"""


@query(license_sql())
def op3_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(table(spark, folder, "documents"), wrapped=True)


@query()
def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op5_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_spans(table(spark, folder, "documents"))


# The shares by weight with the excess of capped sources shared anew, solved by trying for every
# number of capped sources in the order in which they reach their cap; then the overlap of each
# document's place in its source with what is taken, in two rounds.
MIX_SQL = """
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(text, '')) AS digest
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM sizes GROUP BY source),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source NULLS LAST) AS place,
    sum(source_size) OVER () AS total
  FROM sources),
tried AS (
  SELECT a.place - 1 AS capped, any_value(a.source_size) AS own_size, any_value(a.weight) AS own_weight,
    CAST(any_value(3 * a.total) - sum(CASE WHEN b.place < a.place THEN 4 * b.source_size ELSE 0 END) AS BIGINT) AS num,
    CAST(sum(CASE WHEN b.place >= a.place THEN 2 * b.weight ELSE 0 END) AS BIGINT) AS den
  FROM ordered a CROSS JOIN ordered b GROUP BY a.place),
chosen AS (SELECT * FROM tried WHERE 2 * own_size * den > own_weight * num ORDER BY capped LIMIT 1),
aimed AS (
  SELECT o.source, o.source_size,
    CASE WHEN c.capped IS NULL OR o.place <= c.capped THEN CAST(2 * o.source_size AS DOUBLE)
      ELSE CAST(o.weight * c.num AS DOUBLE) / CAST(c.den AS DOUBLE) END AS target,
    CASE WHEN c.capped IS NULL OR o.place <= c.capped THEN 2 * o.source_size ELSE (o.weight * c.num) // c.den END AS goal
  FROM ordered o LEFT JOIN chosen c ON true),
laid AS (
  SELECT s.doc_id, s.size, a.source_size, a.target, a.goal,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(concat('0:', coalesce(CAST(s.doc_id AS VARCHAR), ''), ':', s.digest))
      ROWS UNBOUNDED PRECEDING) - s.size AS start
  FROM sizes s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(start + size, goal) - start)
    + greatest(0, least(source_size + start + size, goal) - source_size - start) AS BIGINT) AS taken
FROM laid
"""


@query(MIX_SQL)
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = mixing.mix(table(spark, folder, "documents"))[1]
    return documents.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op7_katz_backoff(spark: SparkSession, folder: str) -> DataFrame:
    return katz.katz_scores(table(spark, folder, "documents"))


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op9_simhash_bktree(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query()
def op10_invertible_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.fingerprints(table(spark, folder, "documents"))


@query()
def op11_odd_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return oddsketch.near_duplicates(table(spark, folder, "documents"))


@query()
def op12_block_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


# Every document of every term, scored in full.
SEARCH_SQL = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
docs AS (SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM lowered WHERE len(terms) > 0),
totals AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
items AS (
  SELECT row_number() OVER () AS item, item_id,
    list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT item, item_id, unnest(terms) AS term FROM items),
held AS (SELECT row, unnest(terms) AS term FROM docs),
tfs AS (SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term),
impacts AS (
  SELECT t.row, t.term, d.doc_id, w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * (100 - 50 + ((50 * d.n * n_docs) // n_terms)))) AS impact
  FROM tfs t JOIN weights w USING (term) JOIN docs d USING (row), totals),
scored AS (
  SELECT a.item, any_value(a.item_id) AS item_id, i.row, any_value(i.doc_id) AS doc_id, CAST(sum(i.impact) AS BIGINT) AS score
  FROM asked a JOIN impacts i USING (term) GROUP BY a.item, i.row HAVING sum(i.impact) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored QUALIFY rank <= 50
"""


@query(SEARCH_SQL)
def op13_best_positions(spark: SparkSession, folder: str) -> DataFrame:
    return positions.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
