"""The registered queries of this subpackage: thin calls of its operators over
whole tables, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat_format, decontaminate, exact_dedup, jaccard_join, language, license_scan, mixing, quality, repair, sharding, token_files, url_filter
from .scratch import scratch_path
from .sql import centroid_sql, repair_sql

#: The rules of op8.
URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]
#: Scores from here on are of good quality.
GOOD = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where a vocabulary file of the installed public tokenizers is."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def held_out(doc_id):
    """Rows that the quality classifier does not learn from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    labels = _table(spark, sf_dir, "labels")
    return quality.fit(docs, labels.filter(~held_out(F.col("doc_id"))))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, Jaccard 0.85."""
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    digest = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    return exact_dedup.exact_duplicates(docs, carry={"text_sha256": digest})


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2 over the sources, 150 % of all words, no source over twice its size."""
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts are control strings."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(text).alias("text"))
    path, ranks = scratch_path(spark, "chat"), tokenizer_file("byte_bpe_50k.tiktoken")
    chat_format.format_chat(turns.union(more), ranks, path)
    return chat_format.chat_digests(chat_format.read_chat(spark, path), ranks)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), path, end_id=2, vocabulary=49408)
    return token_files.read_token_files(spark, path)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, quality_model(spark, docs, sf_dir), keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards with row counts at most one apart."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = _table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return (sharding.shuffle_into_shards(docs, shards=8)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item of which it has a passage."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged conversations; those that lose all rows count too."""
    rows = _table(spark, sf_dir, "conversations")
    return repair.repair_conversations(repair.damage_turns(rows), rows)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty centroids, five rounds, components times 256."""
    return centroids.cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit_languages(docs.filter(~language.held_out(F.col("doc_id"))))
    found = language.identify_languages(docs, model, keep=["doc_id"])
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_exact_dedup, op3_source_mixing, op4_chat_format, op5_license_scan,
    op6_token_files, op7_quality_classifier, op8_url_filter, op9_sharding, op10_decontamination,
    op11_conversation_repair, op12_centroid_clustering,
    op13_language_id)}

_OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""

_OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix/' || coalesce(doc_id::VARCHAR, 'null') || '/' || coalesce(md5(text), 'null')) AS draw FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
             source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *,
        sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0.0) AS rest,
        sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0) AS rest_weight
      FROM w WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT arg_min(rest / rest_weight, cap / weight) AS level FROM l WHERE cap * rest_weight > rest * weight),
t AS (SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM l, v),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216 + 0.5)::BIGINT ELSE 0 END AS rate,
             ('0x' || substr(md5('mix/offset/' || coalesce(source, '')), 1, 6))::BIGINT AS start FROM t),
c AS (SELECT *, length(bin(size)) AS digits FROM d),
e AS (SELECT *, digits * 64 + (size >> greatest(digits - 6, 0)::INT) AS class, ('0x' || substr(draw, 1, 4))::BIGINT % 256 AS salt FROM c),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, salt, size, draw) AS place FROM e)
SELECT doc_id, size, source_size, target,
       (((start + rate * place) >> 24) - ((start + rate * (place - 1)) >> 24)) * size AS taken
FROM p JOIN r ON p.source IS NOT DISTINCT FROM r.source
"""



def _op5_sql(containment: float = 0.9, window: int = 64) -> str:
    """The license scan over word lists; templates against the window at every offset of every text."""
    phrases = [(p.split(), label) for p, label in license_scan.PHRASES.items()]
    templates = [(sorted(set(t.split())), label) for label, t in license_scan.TEMPLATES.items()]

    def words(names) -> str:
        return "[" + ", ".join(f"'{n}'" for n in names) + "]"

    places = ", ".join(
        f"list_filter(range(len(w) - {len(p) - 1}), lambda i: " + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(p)) + f") AS p{j}"
        for j, (p, _) in enumerate(phrases))
    need = [-(-int(round(containment * 1000)) * len(t) // 1000) for t, _ in templates]
    best = ", ".join(
        f"CASE WHEN len(list_intersect(w, {words(t)})) >= {need[j]} THEN list_max(list_transform(range(0, greatest(1, len(w) - {window - 1})), "
        f"lambda s: len(list_intersect(w[s + 1 : s + {window}], {words(t)})))) ELSE 0 END AS b{j}"
        for j, (t, _) in enumerate(templates))
    base = "[" + ", ".join(f"CASE WHEN len(p{j}) > 0 THEN '{label}' END" for j, (_, label) in enumerate(phrases)) + "]"
    more = "[" + ", ".join(f"CASE WHEN b{j} >= {need[j]} THEN '{label}' END" for j, (_, label) in enumerate(templates)) + "]"
    share = "greatest(0.0, " + ", ".join(f"CASE WHEN b{j} >= {need[j]} THEN b{j} / {len(t)} ELSE 0.0 END" for j, (t, _) in enumerate(templates)) + ")"
    at = "list_concat(" * (len(phrases) - 1) + "p0" + "".join(f", p{j})" for j in range(1, len(phrases)))
    known = "lambda x: x IS NOT NULL"
    return f"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
f AS (SELECT doc_id, len(w) AS n_words, {places}, {best} FROM d),
g AS (SELECT *, {at} AS places, list_filter({base}, {known}) AS base, list_filter({more}, {known}) AS more FROM f)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, more))), ',') AS labels,
       CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE ({share})::DOUBLE END AS score
FROM g
"""


def _op8_sql(damping: float = 0.85, rounds: int = 120, least: float = 0.1) -> str:
    """Rules by a chain of cases; trust and distrust by the operator's recurrence, for so many
    steps that what is left out is far below its tolerance."""
    fits = {r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in URL_RULES}
    longest = sorted(URL_RULES, key=lambda r: (len(r.host + r.path), r), reverse=True)

    def case(value) -> str:
        return "CASE " + " ".join(f"WHEN {fits[r]} THEN '{value(r)}'" for r in longest) + " END"

    def under(hosts) -> str:
        return " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in hosts)

    trusted = sorted({r.host for r in URL_RULES if r.verdict == "allow"})
    blocked = sorted({r.host for r in URL_RULES if r.verdict == "block" and r.path == "/"})
    fold = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE p AS (SELECT page_id, html, {fold.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
l AS (SELECT src, {fold.format('dst')} AS dst FROM (SELECT host AS src,
        unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/"''?#\\s>]+)', 1)) AS dst FROM p)),
links AS (SELECT src, dst, count(*)::DOUBLE AS weight FROM l WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
hosts AS (SELECT host FROM p WHERE host <> '' UNION SELECT dst FROM links),
c AS (SELECT string_split(host, '.') AS c FROM hosts),
u AS (SELECT c, unnest(range(1, len(c) - 1)) AS i FROM c WHERE len(c) > 2),
up AS (SELECT DISTINCT array_to_string(c[i:], '.') AS low, array_to_string(c[i + 1:], '.') AS high FROM u),
edges AS (SELECT src, dst, sum(weight) AS weight FROM (SELECT * FROM links UNION ALL SELECT low, high, 1.0 FROM up WHERE low <> ''
          UNION ALL SELECT high, low, 1.0 FROM up WHERE low <> '') GROUP BY ALL),
shared AS (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS share FROM edges),
ways AS MATERIALIZED (SELECT 'trust' AS kind, dst AS host, src AS via, share FROM shared UNION ALL SELECT 'distrust', src, dst, share FROM shared),
known AS (SELECT host FROM ways UNION SELECT host FROM p),
r(kind, host, k, more) AS (
  (SELECT 'trust', host, 0, 1.0::DOUBLE FROM known WHERE {under(trusted)} UNION ALL SELECT 'distrust', host, 0, 1.0::DOUBLE FROM known WHERE {under(blocked)})
  UNION ALL SELECT w.kind, w.host, any_value(r.k) + 1, {damping} * sum(w.share * r.more) FROM ways w JOIN r ON r.kind = w.kind AND r.host = w.via
            WHERE r.k < {rounds} GROUP BY w.kind, w.host),
s AS (SELECT host, sum(CASE WHEN kind = 'trust' THEN more ELSE 0 END) AS t, sum(CASE WHEN kind = 'distrust' THEN more ELSE 0 END) AS d,
        bool_or(kind = 'trust' AND k = 0) AS ts, bool_or(kind = 'distrust' AND k = 0) AS ds FROM r GROUP BY host)
SELECT page_id, p.host, path, {case(lambda r: r.host + r.path)} AS rule,
       coalesce({case(lambda r: r.verdict)}, CASE WHEN NOT ts AND (ds OR (d >= {least} AND d > t + {url_filter.ROUNDING})) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN (SELECT host AS h, t, d, ts, ds FROM s) ON p.host = h
"""


ORACLE_SQL = {"op2_exact_dedup": _OP2_SQL, "op3_source_mixing": _OP3_SQL, "op5_license_scan": _op5_sql(), "op8_url_filter": _op8_sql(),
              "op11_conversation_repair": repair_sql(), "op12_centroid_clustering": centroid_sql()}
