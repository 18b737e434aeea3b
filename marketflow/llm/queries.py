"""The operators over the tables of a data folder: one query per operator, and SQL where it can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.llm.common import LOWER, UPPER, crc32_mod, read_table
from marketflow.llm.cover_tree import embedding_links
from marketflow.llm.exact_dedup import exact_groups
from marketflow.llm.langid import identify, train_languages
from marketflow.llm.licenses import LESS_EXACT, SPDX, SPDX_ENDING, TEMPLATES, THRESHOLD, WRAP, scan_licenses
from marketflow.llm.line_dedup import drop_common_lines
from marketflow.llm.mixing import mix
from marketflow.llm.packing import pack
from marketflow.llm.pii import KINDS, find_pii, labelled_table, train_pii
from marketflow.llm.runs import find_runs
from marketflow.llm.simhash import near_duplicates
from marketflow.llm.token_counts import count_tokens
from marketflow.llm.toxicity import score_toxicity, train_toxicity
from marketflow.llm.variants import letter_runs, spelling_variants


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return drop_common_lines(docs, min_docs=10, min_chars=1).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, read_table(spark, sf_dir, "labels"), train=lambda c: crc32_mod(c, 5) != 0)
    score = F.col("__llm_toxic")
    return score_toxicity(docs, model).select(
        "doc_id", (crc32_mod(F.col("doc_id"), 5) == 0).alias("held_out"), score.alias("score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("predicted"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(read_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), window=1024)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), limit=1024)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed, sources = mix(docs, F.array("source"), weights=(3, 1, 2), ratio=1.5, cap=2, keep=["doc_id", "source"])
    table = spark.createDataFrame([(name, s.size, s.target) for name, s in sources.items()],
                                  "name string, source_size bigint, target double")
    return (mixed.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("name")))
            .select("doc_id", F.col("__llm_size").alias("size"), "source_size", "target",
                    (F.col("__llm_size") * F.col("__llm_copies")).alias("taken")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a tree ``source/lang/block of 64 ids``; ids that 64, 1024 or 8192 divides are the licence
    files of their block, language or source."""
    docs = read_table(spark, sf_dir, "documents")
    doc_id = F.col("doc_id")
    levels = [F.lit("corpus"), F.col("source"), F.when(doc_id % 8192 != 0, F.col("lang")),
              F.when(doc_id % 1024 != 0, F.floor(doc_id / 64).cast("string"))]
    name = F.when(doc_id % 64 == 0, F.concat(F.lit("LICENSE_"), doc_id)).otherwise(F.concat(F.coalesce(doc_id.cast("string"), F.lit("none")), F.lit(".txt")))
    return scan_licenses(docs.select("doc_id", F.concat_ws("/", *levels, name).alias("path"), "text"), id_col="doc_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train_languages(docs, train=crc32_mod(F.col("doc_id"), 4) != 2)
    return identify(docs, model).select("doc_id", (crc32_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score",
                                        "entropy", "rejected")


def _crc32(*parts) -> Column:
    """Unsigned crc32 of the joined texts, nulls empty."""
    return F.crc32(F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: every tenth document (by crc32 of its id) goes on repeating words of its own from some word on."""
    h, g = F.col("h"), F.floor(F.col("h") / 10)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _crc32(F.col("doc_id")).alias("h"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    n, a, p = F.col("n"), F.col("a"), F.col("p")
    rows = rows.withColumn("w", words).withColumn("n", F.size("w"))
    rows = rows.withColumn("a", (g % F.greatest(n, F.lit(1))).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - a) / (3 + g % 8))).cast("int"))
    times = F.when(n > 0, F.ceil((n - a) / p)).otherwise(0).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("w", a + 1, p), times))
    told = F.array_join(F.concat(F.slice("w", F.lit(1), a), F.slice(tail, F.lit(1), F.greatest(n - a, F.lit(0)))), " ")
    return rows.select("doc_id", F.when(n > 0, told).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(with_repeats(read_table(spark, sf_dir, "documents")), min_length=12)
    ranked = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"])))
    best = F.get(ranked, F.lit(0))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.less") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_*`` and ``base_sha256`` tell of the spans of the rules, ``spans`` and ``n_added`` also of the field's."""
    found = find_pii(read_table(spark, sf_dir, "documents"), train_pii(labelled_table(spark)))
    base = F.filter("spans", lambda s: s["found_by"] == "rule")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.withColumn("base", base).select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"))


def counted_words(docs: DataFrame) -> DataFrame:
    """``word, n``: letter runs lower-cased in A-Z, one in 31 with a letter missing, of at least 7 letters, found at least twice."""
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = docs.select("doc_id", F.explode(letter_runs(lowered, "A-Za-z\u00C0-\u00FF", 7)).alias("run"))
    runs = runs.select("run", _crc32(F.col("doc_id"), F.lit(":"), F.col("run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.left("run", at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % 31 == 0, less).otherwise(F.col("run")).alias("word")).where(F.length("word") >= 7)
    return words.groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(counted_words(read_table(spark, sf_dir, "documents")), ratio=10)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash": op2_simhash,
    "op3_toxicity": op3_toxicity,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_packing": op5_packing,
    "op8_token_counts": op8_token_counts,
    "op9_licenses": op9_licenses,
    "op10_language_id": op10_language_id,
    "op6_mixing": op6_mixing,
    "op7_exact_dedup": op7_exact_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_pii": op12_pii,
    "op13_spelling_variants": op13_spelling_variants,
}

WS_CLASS = r"[\x20\x09-\x0D]"

_LIST = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]::VARCHAR[]"
_TEMPLATE_ROWS = ", ".join(f"({i}, '{t.license}', '{t.text}', {_LIST(t.needs)}, {_LIST(t.forbids)})" for i, t in enumerate(TEMPLATES))
_LESS_ROWS = ", ".join(f"('{more}', '{x}')" for more, less in LESS_EXACT.items() for x in less)

# The table of crc32, and the crc32 of a text's bytes as a lambda over that table.
_CRC_TABLE = """crc(t) AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)))"""


def _crc_sql(text: str) -> str:
    bytes_ = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return (f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {bytes_}), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))")


ORACLE_SQL = {
    "op1_line_dedup": rf"""
WITH l AS (SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
k AS (SELECT doc_id, pos, line,
             translate(regexp_replace(line, '^{WS_CLASS}+|{WS_CLASS}+$', '', 'g'),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, common.key IS NOT NULL AS gone FROM k LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op4_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
     AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT a AS vec_id, a AS seen FROM l UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.seen = l.a),
c AS (SELECT vec_id, min(seen) AS m FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS k FROM l GROUP BY a)
SELECT e.vec_id, coalesce(k, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)""",
    "op9_licenses": rf"""
WITH files AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, doc_id % 64 = 0 AS is_licence,
    concat_ws('/', 'corpus', source, CASE WHEN doc_id % 8192 <> 0 THEN lang END, CASE WHEN doc_id % 1024 <> 0 THEN (doc_id // 64)::VARCHAR END) AS dir FROM documents),
named AS (SELECT *, dir || '/' || CASE WHEN is_licence THEN 'LICENSE_' || doc_id ELSE coalesce(doc_id::VARCHAR, 'none') || '.txt' END AS path FROM files),
templates(i, license, body, needs, forbids) AS (VALUES {_TEMPLATE_ROWS}),
less(more, license) AS (VALUES {_LESS_ROWS}),
ranks AS (SELECT license, min(i) AS rank FROM templates GROUP BY license),
tt AS (SELECT i, term, count(*) AS tf FROM (SELECT i, unnest(regexp_split_to_array(lower(body), '[^a-z0-9]+')) AS term
       FROM templates) WHERE term <> '' GROUP BY ALL),
seen AS (SELECT term, count(DISTINCT r) AS df FROM (
       SELECT r, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS term FROM files)
       WHERE term IN (SELECT term FROM tt) GROUP BY term),
idf AS (SELECT term, ln(((SELECT count(*) FROM files) + 1) / (coalesce(df, 0) + 1)) + 1 AS idf
        FROM (SELECT DISTINCT term FROM tt) LEFT JOIN seen USING (term)),
tv AS (SELECT i, term, tf * idf AS w FROM tt JOIN idf USING (term)),
tn AS (SELECT i, term, w / sqrt(sum(w * w) OVER (PARTITION BY i)) AS share FROM tv),
lines AS (SELECT r, generate_subscripts(l, 1) AS n, unnest(l) AS line FROM (SELECT r, string_split(text, chr(10)) AS l FROM files)),
windows AS (SELECT a.r, a.n * 10 + k AS n, string_agg(b.line, ' ') AS line FROM lines a, range(1, {WRAP + 1}) AS w(k), lines b
            WHERE b.r = a.r AND b.n >= a.n AND b.n < a.n + k GROUP BY a.r, a.n, k HAVING count(*) = k
            UNION ALL SELECT r, 0, text FROM files WHERE is_licence),
terms AS (SELECT r, n, term, count(*) AS tf FROM (SELECT r, n, unnest(regexp_split_to_array(lower(line), '[^a-z0-9]+')) AS term
          FROM windows) WHERE term <> '' GROUP BY ALL),
weighed AS (SELECT r, n, term, tf * coalesce(idf, ln((SELECT count(*) FROM files) + 1) + 1) AS w FROM terms LEFT JOIN idf USING (term)),
norms AS (SELECT r, n, sqrt(sum(w * w)) AS norm, list(term) AS held FROM weighed GROUP BY ALL),
scores AS (SELECT r, n, i, round(sum(w * share) / any_value(norm), 6) AS score, any_value(held) AS held
           FROM weighed JOIN tn USING (term) JOIN norms USING (r, n) GROUP BY r, n, i),
found AS (SELECT r, license, max(score) AS score FROM scores JOIN templates USING (i)
          WHERE score >= {THRESHOLD} AND list_has_all(held, needs) AND NOT list_has_any(held, forbids) GROUP BY r, license
          UNION ALL SELECT r, regexp_replace(regexp_extract(text, '{SPDX}', 1), '{SPDX_ENDING}', ''), 2.0 FROM files
          WHERE regexp_extract(text, '{SPDX}', 1) <> ''),
kept AS (SELECT f.*, coalesce(rank, 1000) AS rank FROM found f LEFT JOIN ranks USING (license)
         WHERE NOT EXISTS (SELECT 1 FROM found g JOIN less ON g.license = less.more WHERE g.r = f.r AND less.license = f.license)),
own AS (SELECT r, license, least(1.0, score) AS score FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, rank, license) AS k FROM kept) WHERE k = 1),
marked AS (SELECT * FROM named LEFT JOIN own USING (r)),
held AS (SELECT dir, path AS from_path, license AS from_license, score AS from_score FROM (
         SELECT *, row_number() OVER (PARTITION BY dir ORDER BY score DESC, path, license) AS k FROM marked WHERE is_licence AND license IS NOT NULL) WHERE k = 1),
up AS (SELECT * FROM (SELECT d.dir, held.from_path, held.from_license, held.from_score,
         row_number() OVER (PARTITION BY d.dir ORDER BY length(held.dir) DESC) AS k
       FROM (SELECT DISTINCT dir FROM marked) d JOIN held ON d.dir = held.dir OR starts_with(d.dir, held.dir || '/')) WHERE k = 1)
SELECT doc_id, path, coalesce(license, from_license) AS license, coalesce(score, from_score) AS score,
       CASE WHEN license IS NOT NULL THEN path ELSE from_path END AS found_in,
       CASE WHEN license IS NOT NULL THEN 'own' WHEN from_license IS NOT NULL THEN 'inherited' END AS origin
FROM marked LEFT JOIN up USING (dir)""",
    "op7_exact_dedup": rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  sha256(regexp_replace(coalesce(text, ''), '{WS_CLASS}', '', 'g')) AS text_sha256
           FROM documents),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id NULLS LAST) AS keep_id,
             row_number() OVER (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id NULLS LAST) = 1 AS kept,
             count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM w""",
    "op11_periodic_runs": rf"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_crc_sql("coalesce(doc_id::VARCHAR, '')")} AS h
      FROM documents, crc),
e AS (SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM d),
f AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
x AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM f),
k AS (SELECT r, n, generate_subscripts(w, 1) - 1 AS i, unnest(w) AS word FROM x),
same AS (SELECT u.r, v.i - u.i AS p, u.i FROM k u JOIN k v ON u.r = v.r AND u.word = v.word AND v.i > u.i AND 2 * (v.i - u.i) <= u.n),
parts AS (SELECT r, p, i, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS part FROM same),
segments AS (SELECT r, p, min(i) AS s, max(i) + p + 1 AS e FROM parts GROUP BY r, p, part),
runs AS (SELECT r, s, e, min(p) AS p FROM segments WHERE e - s >= greatest(12, 2 * p) GROUP BY r, s, e),
sums AS (SELECT r, count(*) AS n_runs, sha256(string_agg(s || ',' || (e - s) || ',' || p || chr(10), '' ORDER BY s, p)) AS runs_sha256,
                first(struct_pack(s := s, l := e - s, p := p) ORDER BY e - s DESC, s, p) AS best FROM runs GROUP BY r),
gone AS (SELECT DISTINCT k.r, k.i FROM k JOIN runs ON k.r = runs.r AND k.i >= runs.s + runs.p AND k.i < runs.e),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM k ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS "start", best.l AS length, best.p AS period, (1000 * best.l) // best.p AS exponent_milli,
       coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM x LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)""",
    "op13_spelling_variants": rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
hashed AS (SELECT run, {_crc_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM (SELECT * FROM runs WHERE length(run) >= 7), crc),
made AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
w AS (SELECT word, count(*) AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cut AS (SELECT word, i, left(word, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest, substr(word, i::INT, 1) AS c
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS (SELECT a.word AS u, b.word AS v FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.c <> b.c
          UNION SELECT cut.word, w.word FROM cut JOIN w ON cut.rest = w.word
          UNION SELECT w.word, cut.word FROM cut JOIN w ON cut.rest = w.word),
best AS (SELECT u, count(*) AS n_near, first(struct_pack(word := v, n := w.n) ORDER BY w.n DESC, v) AS b FROM pairs JOIN w ON v = w.word GROUP BY u),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 10 * n THEN b.word END AS form, CASE WHEN b.n >= 10 * n THEN b.n END AS form_n
          FROM w LEFT JOIN best ON w.word = best.u),
way AS (SELECT word, word AS at FROM forms UNION ALL SELECT way.word, forms.form FROM way JOIN forms ON way.at = forms.word WHERE forms.form IS NOT NULL),
ends AS (SELECT way.word, way.at AS root FROM way JOIN forms ON way.at = forms.word WHERE forms.form IS NULL)
SELECT forms.*, root FROM forms JOIN ends USING (word)""",
}
