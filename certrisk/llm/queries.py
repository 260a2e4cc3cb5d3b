"""The registered queries of the text operators: each applies one to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from certrisk.llm.bpe import encode_decode
from certrisk.llm.licenses import TEMPLATES, licences
from certrisk.llm.line_dedup import dedup_units
from certrisk.llm.middle import digests
from certrisk.llm.mixing import taken
from certrisk.llm.packing import pack
from certrisk.llm.piecewise import compared_with_next
from certrisk.llm.pii import with_spans
from certrisk.llm.set_join import jaccard_components
from certrisk.llm.suffix_dedup import dedup_substrings
from certrisk.llm.tagger import KINDS
from certrisk.llm.quality_classifier import classify
from certrisk.llm.quality_rules import judged
from certrisk.llm.whitening import whitened


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents name their source, which stands for the host, and are in one language, for the path."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                    F.col("source"), F.concat_ws("/", "source", "lang"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def shared_words() -> Column:
    """Words of a document in passages that another has too."""
    return F.aggregate("passages", F.lit(0).cast("long"), lambda n, p: n + p["last"] - p["first"] + 1)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents"), passage_words=50)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                      shared_words().alias("n_shared_words"), F.size("passages").cast("long").alias("n_shared_passages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "kept")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_units(table(spark, sf_dir, "documents"), passage_words=50)
    return out.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), F.array_join(
        F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("removed_spans"),
        shared_words().alias("n_shared_words"), F.size("passages").cast("long").alias("n_shared_passages"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_spans(table(spark, sf_dir, "documents")).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["source"] == "pattern")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def counted(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[counted(k) for k in KINDS[:4]], F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("pii")).alias("spans"), F.size("pii").cast("long").alias("n_spans"),
                        (F.size("pii") - F.size(base)).cast("long").alias("n_added"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", F.expr("length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_piecewise(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = compared_with_next(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                      "edited_fingerprint", "near_edited", "near_next")


def op9_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("text_hash")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whitened(table(spark, sf_dir, "embeddings"))
    if model is None:
        model_columns = [F.lit(None).cast(t).alias(c) for c, t in (("n", "long"), ("explained", "double"), ("identity_error", "double"))]
    else:
        share = F.array(*[F.lit(float(e) / model.trace if model.trace else None).cast("double") for e in model.values])
        model_columns = [F.lit(model.n).cast("long").alias("n"), F.element_at(share, F.col("at") + 1).alias("explained"),
                         F.lit(model.identity_error).cast("double").alias("identity_error")]
    # A deviation that no long can hold is null here; the operator has it as a decimal.
    return rows.select("vec_id", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), model_columns[0], "deviation", "whitened", *model_columns[1:])


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_packing": op2_packing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_pii": op6_pii,
    "op7_bpe": op7_bpe,
    "op8_piecewise": op8_piecewise,
    "op9_set_join": op9_set_join,
    "op10_licenses": op10_licenses,
    "op11_whitening": op11_whitening,
    "op12_fill_middle": op12_fill_middle,
    "op13_mixing": op13_mixing,
}


def _plain(column: str) -> str:
    return f"trim(regexp_replace(lower({column}), '[^a-z0-9]+', ' ', 'g'))"


def _pairs(words: str) -> str:
    return f"list_distinct([{words}[i] || ' ' || {words}[i + 1] FOR i IN range(1, len({words}))])"


#: The same results in DuckDB.
ORACLES = {
    "op10_licenses": f"""
WITH templates AS (
  SELECT licence, {_pairs("words")} AS pairs FROM (
    SELECT licence, string_split({_plain("notice")}, ' ') AS words
    FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in TEMPLATES)}) AS t(licence, notice))
), units AS (
  SELECT doc_id, unnest(range(1, len(lines) + 1)) AS unit, unnest(lines) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
  UNION ALL
  SELECT doc_id, 0, replace(text, chr(10), ' ') FROM documents WHERE contains(text, chr(10))
), sets AS (
  SELECT doc_id, unit, {_pairs("words")} AS own
  FROM (SELECT *, string_split({_plain("line")}, ' ') AS words FROM units) WHERE len(words) > 1
), scored AS (
  SELECT doc_id, unit, licence, 2.0::DOUBLE * len(list_intersect(own, pairs)) / (len(own) + len(pairs)) AS score
  FROM sets, templates WHERE len(own) >= len(pairs) * 0.8 / 1.2 AND len(own) <= len(pairs) * 1.2 / 0.8
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, unit ORDER BY score DESC, licence) AS r FROM scored WHERE score >= 0.8
), found AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences,
         min(struct_pack(s := -score, l := licence)) AS top, string_agg(unit || ':' || licence, ',' ORDER BY unit) AS places
  FROM best WHERE r = 1 GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_matches, coalesce(licences, '') AS licences, top.l AS best_licence,
       round(-top.s, 6) AS best_score, coalesce(places, '') AS places
FROM documents d LEFT JOIN found USING (doc_id)
""",
    "op5_line_dedup": r"""
WITH pieces AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), units AS (
  SELECT doc_id, i, lines[i] AS line,
         coalesce(list_sum([len(x) + 1 for x in lines[1:i-1]]), 0)::BIGINT AS start, len(text) AS size
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM pieces)
), plain AS (
  SELECT *, least(size, start + len(line) + 1)::BIGINT AS stop,
         trim(regexp_replace(lower(line), '[^\pL\pN]+', ' ', 'g')) AS body FROM units
), judged AS (
  SELECT *, body <> '' AND len(string_split(body, ' ')) >= 10 AND
         row_number() OVER (PARTITION BY body ORDER BY doc_id, start) > 1 AS gone FROM plain
), kept AS (
  SELECT doc_id,
         coalesce(string_agg(line || CASE WHEN start + len(line) < size THEN chr(10) ELSE '' END, '' ORDER BY i)
           FILTER (NOT gone), '') AS text,
         count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(start || ':' || stop, ',' ORDER BY i) FILTER (gone), '') AS removed_spans
  FROM judged GROUP BY doc_id
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS body
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words FROM documents))
), steps AS (
  SELECT doc_id, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM windows
  WHERE body IN (SELECT body FROM windows GROUP BY body HAVING count(DISTINCT doc_id) > 1)
), shared AS (
  SELECT doc_id, sum(least(50, coalesce(step, 50)))::BIGINT AS n_words, count(*) FILTER (coalesce(step, 51) > 50) AS n_passages
  FROM steps GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
       coalesce(k.n_removed, 0) AS n_removed, coalesce(k.removed_spans, '') AS removed_spans,
       coalesce(s.n_words, 0) AS n_shared_words, coalesce(s.n_passages, 0) AS n_shared_passages
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN shared s USING (doc_id)
""",
    "op12_fill_middle": r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256(concat('7:', doc_id)) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents
), hashed AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM drawn
), formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM hashed
), parts AS (
  SELECT *, array_to_string(u[1:p], '') AS prefix, array_to_string(u[p+1:q], '') AS middle,
         array_to_string(u[q+1:], '') AS suffix FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
              ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
""",
    "op13_mixing": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::HUGEINT AS w FROM d GROUP BY source
), falling AS (  -- the sources that reach their limit first, and what is left for the others
  SELECT *, sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER before, 0) AS left_words,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS left_w FROM s
  WINDOW before AS (ORDER BY source_size / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT left_words::HUGEINT AS words, left_w::HUGEINT AS ws FROM falling WHERE 3 * source_size * left_w >= left_words * w
  ORDER BY source_size / w::DOUBLE, source NULLS LAST LIMIT 1
), t AS (
  SELECT source, source_size, 3 * source_size * ws < words * w AS held, w * words AS up, ws * greatest(source_size, 1) AS down,
         w * words / ws::DOUBLE AS share, ('0x' || md5(concat('13:', source))[1:5])::HUGEINT AS u FROM s, level
), f AS (
  SELECT source, source_size, CASE WHEN held OR source_size = 0 THEN 3.0::DOUBLE * source_size ELSE share END AS target,
         CASE WHEN held THEN 3 ELSE up END AS up, CASE WHEN held THEN 1 ELSE down END AS down, u FROM t
), r AS (
  SELECT d.*, f.*, row_number() OVER (PARTITION BY d.source ORDER BY size, md5(concat('13:', doc_id)), doc_id)::HUGEINT AS i
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * ((i * up * 1048576 + u * down) // (down * 1048576) - ((i - 1) * up * 1048576 + u * down) // (down * 1048576)))::BIGINT AS taken
FROM r
""",
}
