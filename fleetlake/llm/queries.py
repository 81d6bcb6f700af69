"""Registered queries of the corpus operators: each applies one operator to its whole
table with production parameters. ``SQL`` holds DuckDB twins where SQL expresses one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 on ``embeddings``: links within a label, component and whether the row stays."""
    from fleetlake.llm.lattice import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 on ``documents``: the licences that passages of each text match."""
    from fleetlake.llm.licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 on ``documents``: fingerprint, component and whether the row stays."""
    from fleetlake.llm.simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 on ``documents``: every token piece with its place; the ids' CRC-32 stands for the ids."""
    from fleetlake.llm.packing import pack, token_pieces

    pieces = token_pieces(_table(spark, sf_dir, "documents"))
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 on ``documents``: what is removed, and the digest of the bytes that remain."""
    from fleetlake.llm.suffixes import remove_repeats

    out = remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 on ``documents``: bytes and tokens of every whole text."""
    from fleetlake.llm.tokens import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents"))


def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 on ``pages``: the main text of every page."""
    from fleetlake.llm.html_text import extract_main_text

    return extract_main_text(_table(spark, sf_dir, "pages"))


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 on ``documents``: domains are the languages of the documents that ``labels`` covers;
    a row for each distinct (id, text) with its posteriors and rate."""
    from fleetlake.llm.mixing import labelled_domains, mix

    docs = _table(spark, sf_dir, "documents")
    return mix(docs, labelled_domains(docs, _table(spark, sf_dir, "labels")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 on ``documents``: base measures, repetition coverage and the verdict."""
    from fleetlake.llm.repetition import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: fitted on rated rows of ``labels``, applied to all ``documents``."""
    from fleetlake.llm.ordinal import classify, grades_from_labels, train

    docs = _table(spark, sf_dir, "documents")
    return classify(docs, train(docs, grades_from_labels(_table(spark, sf_dir, "labels"))))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11 on ``documents``: the group of every row and whether it stays."""
    from fleetlake.llm.exact import exact_duplicates

    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12 on ``documents``, one in ten of which (by a CRC of its id) is made periodic from some word on."""
    from fleetlake.llm.periodic import collapse_runs

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    words = F.expr("filter(split(text, '[ \\t-\\r]+'), w -> w <> '')")
    docs = docs.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    docs = docs.withColumn("a", F.expr("if(n > 0, g % n, null)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    periodic = F.expr("array_join(transform(sequence(0, n - 1), i -> words[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    out = collapse_runs(docs.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text")), digests=True)
    return out.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.col("runs").alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13 on ``documents``: what each of five filters removes in every order, by language."""
    from fleetlake.llm.filter_audit import audit, text_failures

    docs = text_failures(_table(spark, sf_dir, "documents"))
    return audit(docs, _table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_lattice, op2_license_scan, op3_simhash, op4_best_fit_packing, op5_suffix_array, op6_token_counts, op7_html_main_text, op8_soft_mixing,
                                   op9_quality_rules, op10_quality_classifier, op11_exact_dedup, op12_periodic_runs, op13_filter_audit)}
SQL: dict[str, str] = {
    "op1_lattice": """WITH RECURSIVE g AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
n AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM g WHERE list_dot_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT links.a, reach.other FROM links JOIN reach ON links.b = reach.id),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
many AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = id LEFT JOIN many ON vec_id = a""",
    "op9_quality_rules": """WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
ls AS (
  SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again,
    list_sum(list_transform(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'), lambda y: length(y))) AS chars
  FROM (SELECT doc_id, unnest(string_split(x, chr(10))) AS line, generate_subscripts(string_split(x, chr(10)), 1) AS i FROM t)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(chars) FILTER (again), 0) AS dup_line_chars
  FROM ls GROUP BY doc_id),
windows AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM t CROSS JOIN (SELECT unnest([3, 5, 6, 7, 8, 9, 10]) AS k) WHERE len(w) >= k),
grams AS (
  SELECT doc_id, k, i, count(*) OVER same AS many, row_number() OVER (PARTITION BY doc_id, k, gram ORDER BY i) AS nth
  FROM (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram FROM windows) WINDOW same AS (PARTITION BY doc_id, k, gram)),
cover AS (
  SELECT DISTINCT doc_id, k, i + j AS p FROM grams CROSS JOIN (SELECT unnest(range(0, 10)) AS j)
  WHERE j < k AND CASE WHEN k = 3 THEN many > 1 ELSE nth > 1 END),
inside AS (
  SELECT doc_id, k, count(*) AS words, sum(length(w[p])) AS chars FROM cover JOIN t USING (doc_id) GROUP BY doc_id, k),
c AS (
  SELECT doc_id, coalesce(max(words) FILTER (k = 3), 0) AS n_repeat_words, coalesce(max(chars) FILTER (k = 5), 0) AS c5,
    coalesce(max(chars) FILTER (k = 6), 0) AS c6, coalesce(max(chars) FILTER (k = 7), 0) AS c7, coalesce(max(chars) FILTER (k = 8), 0) AS c8,
    coalesce(max(chars) FILTER (k = 9), 0) AS c9, coalesce(max(chars) FILTER (k = 10), 0) AS c10
  FROM inside GROUP BY doc_id),
m AS (
  SELECT t.doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda y: length(y))), 0) AS BIGINT) AS word_chars,
    length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, CAST(coalesce(dup_line_chars, 0) AS BIGINT) AS dup_line_chars,
    CAST(coalesce(c5, 0) AS BIGINT) AS dup_chars_5, CAST(coalesce(c6, 0) AS BIGINT) AS dup_chars_6, CAST(coalesce(c7, 0) AS BIGINT) AS dup_chars_7,
    CAST(coalesce(c8, 0) AS BIGINT) AS dup_chars_8, CAST(coalesce(c9, 0) AS BIGINT) AS dup_chars_9, CAST(coalesce(c10, 0) AS BIGINT) AS dup_chars_10
  FROM t LEFT JOIN lines USING (doc_id) LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT (base_failed OR n_dup_lines > CAST(0.3 AS DOUBLE) * n_lines OR dup_line_chars > CAST(0.2 AS DOUBLE) * word_chars
  OR dup_chars_5 > CAST(0.15 AS DOUBLE) * word_chars OR dup_chars_6 > CAST(0.14 AS DOUBLE) * word_chars OR dup_chars_7 > CAST(0.13 AS DOUBLE) * word_chars
  OR dup_chars_8 > CAST(0.12 AS DOUBLE) * word_chars OR dup_chars_9 > CAST(0.11 AS DOUBLE) * word_chars
  OR dup_chars_10 > CAST(0.1 AS DOUBLE) * word_chars) AS kept FROM f""",
    "op11_exact_dedup": """WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS bare FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY bare ORDER BY points DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM g""",
    "op12_periodic_runs": """WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS v,
    -- CRC-32 of the decimal id, bit by bit
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda s, c: list_reduce(list_concat([xor(s, c)], range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) AS h
  FROM documents),
m AS (SELECT doc_id, v, h, h // 10 AS g, len(v) AS n FROM t),
o AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM m),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM o),
w AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: v[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE v END AS w FROM p),
grams AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(0, n - 5)) AS i FROM w WHERE n >= 12)),
-- every match of six words a lag apart; consecutive ones are one stretch of its diagonal
pairs AS (SELECT x.doc_id, y.i - x.i AS q, x.i, x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS island
  FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
stretches AS (SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 6 + q AS length FROM pairs GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, start, length, min(q) AS q FROM stretches WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
told AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS runs,
    first(struct_pack(s := start, l := length, q := q) ORDER BY length DESC, start, q) AS top FROM runs GROUP BY doc_id),
gone AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(start + q, start + length)) AS i FROM runs) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.l AS length, top.q AS period, 1000 * top.l // top.q AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(n), lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256
FROM w LEFT JOIN told USING (doc_id) LEFT JOIN gone USING (doc_id)""",
    "op13_filter_audit": """WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
f AS (
  SELECT doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * (length(x) - length(regexp_replace(x, '[A-Z]', '', 'g'))) > 10 * length(x),
    regexp_matches(x, '[#$%&*|]'), doc_id > min(doc_id) OVER (PARTITION BY x)] AS fails,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND quality = 1) AS good, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND toxic = 1) AS toxic
  FROM w),
kinds AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
five AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM five a, five b, five c, five d, five e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, k.i AS step, o[1:k.i - 1] AS earlier, o[k.i] AS f FROM orders, five k),
rows_ AS (
  SELECT part, filter_order, step, f, n, good, toxic, fails[f] AS here, len(list_filter(earlier, lambda i: fails[i])) > 0 AS gone,
    len(list_filter(fails, lambda x: x)) = 1 AS single FROM kinds, steps),
each_ AS (
  SELECT part, filter_order, step, f, sum(n) FILTER (NOT here AND NOT gone) AS kept, sum(n) FILTER (here AND NOT gone) AS removed, sum(n) FILTER (here AND gone) AS redundant,
    sum(n) FILTER (here AND single) AS unique_fails, sum(good) FILTER (here AND NOT gone) AS good_lost, sum(toxic) FILTER (here AND NOT gone) AS toxic_lost
  FROM rows_ GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM each_""",
}
