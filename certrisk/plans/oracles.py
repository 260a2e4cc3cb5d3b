"""The same results in DuckDB SQL, computed from source columns without parsing any capture."""

from __future__ import annotations

from certrisk import constants as k
from certrisk.sources.derived import PROPERTIES


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


PROPS = f"props AS ({PROPERTIES})"

# Expected features of a text capture.
FEATURES = f"""{PROPS},
keyed AS (
  SELECT *, CASE WHEN self_signed
      THEN concat(n_name, '#', org, '#', coalesce(cn, '')) ELSE concat('ca#', ca) END AS issuer_id,
    CASE WHEN date_form = 'mixed' THEN 0 ELSE days END AS v,
    coalesce(bits, 0) AS b, lower(coalesce(cn, '')) AS cnl
  FROM props),
issuers AS (
  SELECT issuer_id, count(*) / (SELECT count(*) FROM keyed) AS issuer_frequency
  FROM keyed GROUP BY issuer_id),
feat AS (
  SELECT keyed.*, issuer_frequency,
    coalesce(list_max(list_filter(list_transform({_list(k.BRANDS)},
      lambda x: CASE WHEN contains(cnl, x) THEN 1.0::DOUBLE
        ELSE 1 - levenshtein(cnl, x) / greatest(length(cnl), length(x)) END),
      lambda s: s > 0.7)), 0.0) AS similarity,
    3 * has_link::INT + 2 * has_alarm::INT AS n_words,
    coalesce(contains(cn, 'xn--'), false) AS puny, coalesce(contains(cn, 'а'), false) AS foreign_letter,
    sig LIKE 'sha1%' AS sha1, sig LIKE 'md5%' AS md5sig
  FROM keyed JOIN issuers USING (issuer_id))"""

_CONDITIONS = {
    "short_validity_period": "v > 0 AND v < 7",
    "long_validity_period": "v > 398",
    "weak_public_key": "b > 0 AND b < 2048",
    "weak_signature_algorithm": "sha1 OR md5sig",
    "punycode_domain": "puny",
    "homoglyph_characters": "foreign_letter",
    "brand_typosquatting": "similarity > 0.7 AND similarity < 1",
    "self_signed": "self_signed",
    "rare_issuer_short_validity": "issuer_frequency < 0.001 AND v < 90",
    "url_in_certificate": "has_link",
    "suspicious_keywords": "n_words >= 2",
    "missing_chain": "chain = 0",
    "no_san": "true",
}
_VALUES = {
    "short_validity_period": ["v"],
    "long_validity_period": ["v"],
    "weak_public_key": ["b", "2048"],
    "weak_signature_algorithm": ["CASE WHEN sha1 THEN 'SHA1' ELSE 'MD5' END"],
    "brand_typosquatting": ["similarity"],
    "suspicious_keywords": ["n_words"],
}


def _reason(name: str, form: str) -> str:
    quoted = "'" + form.replace("'", "''") + "'"
    return f"printf({', '.join([quoted, *_VALUES[name]])})" if name in _VALUES else quoted


_WEIGHTS = " + ".join(
    f"CASE WHEN {_CONDITIONS[n]} THEN {w}::DOUBLE ELSE 0 END" for n, w, _, _ in k.RULE_TABLE)
_FIRED = "list_filter([" + ", ".join(
    f"CASE WHEN {_CONDITIONS[n]} THEN '{n}' END" for n, *_ in k.RULE_TABLE
) + "], lambda x: x IS NOT NULL)"
_REASONS = "list_filter([" + ", ".join(
    f"CASE WHEN {_CONDITIONS[n]} THEN {_reason(n, f)} END" for n, _, f, _ in k.RULE_TABLE
) + "], lambda x: x IS NOT NULL)"

RULED = f"""{FEATURES},
fired AS (SELECT *, {_FIRED} AS triggered, {_REASONS} AS reasons, {_WEIGHTS} AS total FROM feat),
ruled AS (
  SELECT *, CASE WHEN len(triggered) >= 3 THEN least(1.0::DOUBLE, total / len(triggered) * 1.2::DOUBLE)
      WHEN len(triggered) > 0 THEN total / len(triggered) ELSE 0.0 END AS rule_score
  FROM fired)"""

SCORED = f"""{RULED},
scored AS (
  SELECT *, CASE WHEN k % 3 <> 0 THEN (k % 11) / 10 END AS ml,
    CASE WHEN k % 4 = 0 THEN 'phishing' WHEN k % 4 = 1 THEN 'benign' WHEN k % 4 = 2 THEN 'unknown' END AS llm_label,
    (k % 7) / 8 AS llm_conf
  FROM ruled),
finals AS (
  SELECT *, CASE WHEN llm_label = 'phishing' THEN llm_conf WHEN llm_label = 'benign' THEN 1 - llm_conf
      ELSE 0.5::DOUBLE END AS llm
  FROM scored),
verdicts AS (
  SELECT *, 0.25::DOUBLE * rule_score + 0.35::DOUBLE * coalesce(ml, 0.5::DOUBLE) + 0.4::DOUBLE * llm AS final_score
  FROM finals)"""

LABELLED = """rows AS (
  SELECT quality AS y, round(least(n_chars / 4000, 1.0), 2) AS score
  FROM labels JOIN documents USING (doc_id)),
pred AS (SELECT y, score, (score >= 0.25)::INT AS p FROM rows),
cm AS (
  SELECT count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp,
    count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 1 AND p = 1) AS tp
  FROM pred)"""


def _share(part: str, whole: str) -> str:
    return f"coalesce(({part}) / nullif({whole}, 0), 0)"


# Ranking metrics per group: running counts over distinct scores.
def _ranking(source: str, by: str) -> str:
    return f"""g AS (
  SELECT {by}, score, sum(y) AS pos, sum(1 - y) AS neg FROM {source} GROUP BY ALL),
c AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM g
  WINDOW w AS (PARTITION BY {by} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
rank_m AS (
  SELECT {by}, sum(neg * (tp - pos) + neg * pos / 2) / sum(pos) / sum(neg) AS roc_auc,
    sum(tp / (tp + fp) * pos) / sum(pos) AS pr_auc
  FROM c GROUP BY {by})"""


METHODS = f"""WITH {SCORED},
m AS (
  SELECT CASE WHEN label = 'phishing' THEN 1 ELSE 0 END AS y, rule_score AS r,
    coalesce(ml, 0.5::DOUBLE) AS m, llm AS l FROM finals)"""

SUPPLIERS = """s AS (
  SELECT s_suppkey AS k, s_name, n_name, concat('supplier', s_suppkey, '.example') AS cn,
    CASE WHEN s_suppkey % 2 = 0 THEN 'benign' ELSE 'phishing' END AS label,
    s_suppkey % 20 + 1 AS v, s_suppkey % 5 = 0 AS has_link, s_suppkey % 3 AS ca
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
# Rules that can fire on a supplier capture: short life, link, no alternative names.
SUPPLIER_SCORES = f"""{SUPPLIERS},
t AS (
  SELECT *, CASE WHEN v < 7 THEN 0.8::DOUBLE ELSE 0 END + CASE WHEN has_link THEN 0.5::DOUBLE ELSE 0 END
      + 0.3::DOUBLE AS total, 1 + (v < 7)::INT + has_link::INT AS n FROM s),
f AS (
  SELECT *, 0.25::DOUBLE * CASE WHEN n >= 3 THEN least(1.0::DOUBLE, total / n * 1.2::DOUBLE) ELSE total / n END
      + 0.375::DOUBLE AS final_score FROM t)"""

_WORDS = r"regexp_extract_all(lower(strip_accents(lower(text))), '[\p{L}\p{N}_]{2,}')"

_GRAMS = f"""d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (
  SELECT doc_id, unnest(w) AS term FROM d
  UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) FROM d
  UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w) - 1),
    lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))) FROM d),
counted AS (SELECT doc_id, term, count(*) AS n FROM g GROUP BY ALL),
total AS (SELECT count(*) AS documents FROM documents),
stats AS (
  SELECT term, sum(n)::BIGINT AS occurrences, count(*) AS documents FROM counted GROUP BY term),
top AS (
  SELECT stats.*, row_number() OVER (ORDER BY occurrences DESC, term) - 1 AS position,
    ln((1 + total.documents) / (1 + stats.documents)) + 1 AS idf
  FROM stats, total WHERE stats.documents BETWEEN 2 AND 0.9 * total.documents
  QUALIFY position < 300)"""

# Numbers of the small model, scaled, and their fit: Newton steps in a recursive query. Each step sums the
# gradient and the second derivatives over distinct rows and eliminates one unknown after the other.
_NUMBERS = ("v", "b", "chain", "puny::INT", "similarity", "self_signed::INT", "has_link::INT", "n_words", "issuer_frequency")
_NAMES = ("validity_days", "pubkey_bits", "chain_length", "subject_has_punycode", "max_brand_similarity",
          "is_self_signed", "has_url", "suspicious_keyword_count", "issuer_frequency")
_N = len(_NUMBERS) + 1


def _scaled(x: str) -> str:
    return f"(({x})::DOUBLE - avg(({x})::DOUBLE) OVER ()) / coalesce(nullif(stddev_pop(({x})::DOUBLE) OVER (), 0), 1)"


def _newton_step() -> str:
    xs = ["1.0::DOUBLE", *[f"x{i}" for i in range(1, _N)]]
    ws = [f"w{i}" for i in range(_N)]
    score = " + ".join(f"{w} * {x}" for w, x in zip(ws, xs))
    cells = [(i, j) for i in range(_N) for j in range(i, _N)]
    sums = [f"sum(c * (p - y) * {xs[i]}) + {'0' if not i else ws[i]} AS g{i}" for i in range(_N)]
    sums += [f"sum(c * p * (1 - p) * {xs[i]} * {xs[j]}) + {1 if i == j and i else 0} AS h{i}_{j}" for i, j in cells]
    carried = ["step", *ws]
    sql = (f"SELECT {', '.join(carried + sums)} FROM (SELECT fit.*, x.*, 1 / (1 + exp(-({score}))) AS p "
           f"FROM fit, x WHERE step < 12) GROUP BY {', '.join(carried)}")
    for k in range(_N - 1):  # eliminate unknown k from the rows below
        new = [f"g{i} - h{k}_{i} / h{k}_{k} * g{k} AS g{i}" if i > k else f"g{i}" for i in range(_N)]
        new += [f"h{i}_{j} - h{k}_{i} / h{k}_{k} * h{k}_{j} AS h{i}_{j}" if i > k else f"h{i}_{j}" for i, j in cells]
        sql = f"SELECT {', '.join(carried + new)} FROM ({sql})"
    rest = [f"g{i}" for i in range(_N)] + [f"h{i}_{j}" for i, j in cells]
    for k in range(_N - 1, -1, -1):  # and put the solved ones in
        known = "".join(f" - h{k}_{j} * d{j}" for j in range(k + 1, _N))
        solved = [f"d{j}" for j in range(k + 1, _N)]
        sql = f"SELECT {', '.join(carried + rest + solved)}, (g{k}{known}) / h{k}_{k} AS d{k} FROM ({sql})"
    return f"SELECT step + 1, {', '.join(f'w{i} - d{i}' for i in range(_N))} FROM ({sql})"


SCALED = f"""{FEATURES},
z AS MATERIALIZED (
  SELECT k, CASE WHEN label = 'phishing' THEN 1 ELSE 0 END AS y, {", ".join(f"{_scaled(x)} AS x{i}" for i, x in enumerate(_NUMBERS, 1))}
  FROM feat)"""
FIT = f"""{SCALED},
x AS MATERIALIZED (
  SELECT y, {", ".join(f"x{i}" for i in range(1, _N))},
    n * sum(n) OVER () / (2.0::DOUBLE * sum(n) OVER (PARTITION BY y)) AS c
  FROM (SELECT * EXCLUDE (k), count(*) AS n FROM z GROUP BY ALL)),
fit AS (
  SELECT 0 AS step, {", ".join(f"0.0::DOUBLE AS w{i}" for i in range(_N))}
  UNION ALL {_newton_step()}),
last AS (SELECT * FROM fit WHERE step = 12)"""

# Files with a link are too long; of the others every seventh is unreadable.
OUTCOMES = f"""{SUPPLIER_SCORES},
o AS (
  SELECT *, CASE WHEN has_link THEN 'longer than 215 bytes' WHEN k % 7 = 3 THEN 'unreadable' ELSE 'parsed' END AS outcome FROM f)"""

ORACLES: dict[str, str] = {
    "verdict_summary": f"""WITH {RULED}, f AS (
  SELECT 0.25::DOUBLE * rule_score + 0.35::DOUBLE * 0.5 + 0.4::DOUBLE * 0.5 AS s FROM ruled)
SELECT CASE WHEN s >= 0.5 THEN 'phishing' ELSE 'benign' END AS label,
  CASE WHEN s >= 0.8 OR s <= 0.3 THEN 'high' ELSE 'medium' END AS confidence,
  count(*) AS captures, round(avg(s), 6) AS avg_score
FROM f GROUP BY 1, 2""",
    "sniff_type": """WITH x AS (
  SELECT 'page' AS origin, page_id AS id, html AS text FROM pages
  UNION ALL SELECT 'document', doc_id, text FROM documents),
h AS (SELECT origin, id, encode(text) AS b FROM x),
heads AS (
  SELECT origin, id, coalesce(try(decode(b[1:8192])), try(decode(b[1:8191])),
    try(decode(b[1:8190])), try(decode(b[1:8189]))) AS head FROM h)
SELECT origin, id, CASE WHEN contains(head, '-----BEGIN CERTIFICATE-----') THEN 'pem'
  WHEN contains(head, 'Certificate chain') OR contains(head, 'Server certificate')
    OR contains(head, 'subject=') OR contains(head, 'issuer=') OR contains(head, 'CONNECTED(') THEN 'openssl_text'
  WHEN 1 - length(regexp_replace(head, '[\\x00-\\x7F]', '', 'g')) / nullif(length(head), 0) > 0.9 THEN 'openssl_text'
  ELSE 'unknown' END AS file_type FROM heads
UNION ALL SELECT 'dump', o_orderkey, 'openssl_text' FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "sniff_der": f"WITH {PROPS} SELECT k, 'der' AS file_type FROM props",
    "binary_source": f"""WITH {SUPPLIERS}
SELECT label, 'openssl_text' AS file_type, concat('supplier', k) AS name,
  length(concat('CONNECTED(00000003)|Certificate chain| 0 s:x|subject=C = ', n_name, ', O = ', s_name,
    ', CN = supplier', k, '.example|issuer=CN = CA ', ca, '|notBefore=Jan  1 00:00:00 2024 GMT|notAfter=Jan ',
    '00 00:00:00 2024 GMT|', CASE WHEN has_link THEN 'https://login.example/verify|' ELSE '' END)) AS n_chars
FROM s""",
    "jobs_preprocess": f"""WITH {SUPPLIERS}
SELECT cn, label, v::INT AS validity_days, has_link::INT AS has_url,
  round(count(*) OVER (PARTITION BY ca) / count(*) OVER (), 6) AS issuer_frequency FROM s""",
    "unreadable_files": f"""WITH {OUTCOMES}
SELECT label, outcome, CASE WHEN outcome = 'parsed' THEN cn ELSE '' END AS cn, count(*) AS files FROM o GROUP BY ALL""",
    "infer_with_errors": f"""WITH {OUTCOMES}
SELECT CASE WHEN outcome = 'parsed' THEN 'ok' ELSE 'error' END AS status, CASE WHEN outcome = 'parsed' THEN cn ELSE '' END AS cn,
  count(*) AS files, round(avg(CASE WHEN outcome = 'parsed' THEN final_score ELSE {{errors}} END), 6) AS final_score
FROM o GROUP BY ALL""".replace(
        # A file without content has neither a chain nor alternative names.
        "{errors}", f"0.25::DOUBLE * ({' + '.join(str(w) for n, w, *_ in k.RULE_TABLE if n in ('missing_chain', 'no_san'))}) / 2 + 0.375"),
    "incremental_preprocess": """
SELECT 0 AS run, count(*) AS new_files, count(*) AS new_contents FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL SELECT 1, count(*) FILTER (s_suppkey % 3 = 0) + count(*) FILTER (s_suppkey % 5 = 1), count(*) FILTER (s_suppkey % 3 = 0) FROM supplier
UNION ALL SELECT 2, 0, 0""",
    "incremental_features": f"""WITH {SUPPLIERS},
c AS (SELECT *, 1 + (k % 3 <> 0 AND k % 5 = 1)::INT AS n FROM s)
SELECT cn, label, n::BIGINT AS n_files, has_link::INT AS has_url,
  round(sum(n) OVER (PARTITION BY ca) / sum(n) OVER (), 6) AS issuer_frequency FROM c""",
    "watch_captures_once": f"""WITH {SUPPLIER_SCORES}
SELECT cn, CASE WHEN final_score >= 0.5 THEN 'phishing' ELSE 'benign' END AS label,
  round(final_score, 6) AS final_score FROM f""",
    "jobs_batch_infer": f"""WITH {SUPPLIER_SCORES}
SELECT cn, CASE WHEN final_score >= 0.5 THEN 'phishing' ELSE 'benign' END AS label,
  round(final_score, 6) AS final_score, 'medium' AS confidence FROM f""",
    "watch_captures": f"""WITH {SUPPLIER_SCORES}
SELECT cn, CASE WHEN final_score >= 0.5 THEN 'phishing' ELSE 'benign' END AS label,
  round(final_score, 6) AS final_score FROM f""",
    "incremental_captures": """SELECT source, count(*) AS new_documents FROM documents
WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE source = 'src0')
GROUP BY source""",
    "sample_labels": """SELECT doc_id, toxic FROM (
  SELECT doc_id, toxic::BIGINT AS toxic, row_number() OVER (
    PARTITION BY toxic ORDER BY md5(concat(doc_id, '#42'))) AS r FROM labels) WHERE r <= 40""",
    "hash_split": """WITH u AS (
  SELECT doc_id, ('0x' || md5(concat(doc_id, '#42'))[1:8])::BIGINT / 4294967296 AS x FROM documents)
SELECT doc_id, CASE WHEN x < 0.7 THEN 'train' WHEN x < 0.85 THEN 'validation' ELSE 'test' END AS split FROM u""",
    "parse_text_fields": f"""WITH {PROPS}
SELECT k, concat('capture-', k) AS file_name, label, cn,
  CASE WHEN self_signed THEN cn ELSE ca END AS issuer_cn, bits::BIGINT AS bits, key_type AS pubkey_type,
  sig AS signature_algorithm, chain::BIGINT AS chain, 0::BIGINT AS warnings FROM props""",
    "parse_dn": f"""WITH {PROPS}
SELECT k, 'C' AS key, n_name AS value FROM props
UNION ALL SELECT k, 'O', org FROM props
UNION ALL SELECT k, 'CN', cn FROM props WHERE cn IS NOT NULL""",
    "validity_days": f"""WITH {PROPS}
SELECT k, CASE WHEN date_form <> 'mixed' THEN days::BIGINT END AS days,
  epoch(o_orderdate)::BIGINT AS starts, (epoch(o_orderdate) + 86400 * days)::BIGINT AS ends FROM props""",
    "handshake": f"""WITH {PROPS}
SELECT k, concat('DEMO-AES256-', k % 5) AS cipher, protocol,
  CASE WHEN has_link THEN concat('https://host', k, '.example/login?id=', k) END AS url FROM props""",
    "x509_decode": f"""WITH {PROPS}
SELECT k, cn, c_name AS org, n_name AS country, ca AS issuer_cn,
  CASE WHEN k % 3 = 0 THEN '' ELSE concat('host', k, '.example|www.host', k, '.example') END AS san,
  strftime(o_orderdate, '%Y-%m-%dT00:00:00+00:00') AS not_before,
  strftime(o_orderdate + to_days(days::INT), '%Y-%m-%dT00:00:00+00:00') AS not_after, days::BIGINT AS days,
  CASE WHEN bits = 256 THEN 'EC' ELSE 'RSA' END AS pubkey_type,
  CASE WHEN bits = 2047 THEN 2048 ELSE coalesce(bits, 4096) END::BIGINT AS bits, sig AS signature_algorithm,
  1::BIGINT AS chain, 0::BIGINT AS warnings FROM props""",
    "structural": f"""WITH {FEATURES}
SELECT k, v::BIGINT AS validity_days, b::BIGINT AS pubkey_bits, chain::BIGINT AS chain_length,
  0::BIGINT AS san_count, 0::BIGINT AS has_san, 0::BIGINT AS parse_warning_count, 0::BIGINT AS has_parse_warnings,
  (key_type = 'rsaEncryption')::BIGINT AS pubkey_is_rsa, (key_type = 'id-ecPublicKey')::BIGINT AS pubkey_is_ecc,
  (sig LIKE 'sha256%')::BIGINT AS sig_is_sha256, sha1::BIGINT AS sig_is_sha1, md5sig::BIGINT AS sig_is_md5
FROM feat""",
    "temporal": f"""WITH {FEATURES}
SELECT k, (v > 0 AND v < 7)::BIGINT AS validity_very_short, (v >= 7 AND v < 30)::BIGINT AS validity_short,
  (v >= 30 AND v < 90)::BIGINT AS validity_medium, (v >= 90 AND v <= 398)::BIGINT AS validity_standard,
  (v > 398)::BIGINT AS validity_long FROM feat""",
    "lexical": r"""WITH n AS (
  SELECT doc_id, length(text) AS len, length(regexp_replace(text, '[^\p{Nd}]', '', 'g')) AS d,
    length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS u,
    length(regexp_replace(text, '[\p{L}\p{N}\s\x0b\x1c-\x1f\x{85}\p{Z}]', '', 'g')) AS s,
    length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) AS f FROM documents)
SELECT doc_id, len AS text_length, d AS digit_count, round(d / len, 6) AS digit_ratio, u AS upper_count,
  round(u / len, 6) AS upper_ratio, s AS special_char_count, round(s / len, 6) AS special_char_ratio,
  f AS non_ascii_count, round(f / len, 6) AS non_ascii_ratio FROM n""",
    "entropy": """WITH c AS (
  SELECT doc_id, ch, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents)
  GROUP BY ALL),
t AS (SELECT doc_id, n, sum(n) OVER (PARTITION BY doc_id) AS total FROM c)
SELECT doc_id, round(-sum(n / total * log2(n / total)), 6) AS entropy FROM t GROUP BY doc_id""",
    "keywords_urls_ips": f"""WITH x AS (
  SELECT 'document' AS origin, doc_id AS id, text FROM documents
  UNION ALL SELECT 'url', page_id, url FROM pages),
n AS (SELECT *, len(regexp_extract_all(text, 'https?://[^\\s]+')) AS u FROM x)
SELECT origin, id, u AS url_count, (u > 0)::BIGINT AS has_url,
  len(list_filter({_list(k.SUSPICIOUS_WORDS)}, lambda w: contains(lower(text), w))) AS suspicious_keyword_count,
  len(regexp_extract_all(text, '\\b(?:\\d{{1,3}}\\.){{3}}\\d{{1,3}}\\b')) AS ip_count FROM n""",
    "identity": f"""WITH {FEATURES}
SELECT k, length(coalesce(cn, '')) AS subject_cn_length, coalesce(contains(cn, '*'), false)::BIGINT AS subject_cn_has_wildcard,
  round(length(regexp_replace(coalesce(cn, ''), '[^0-9]', '', 'g')) / greatest(length(coalesce(cn, '')), 1), 6)
    AS subject_cn_digit_ratio,
  puny::BIGINT AS subject_has_punycode, 0::BIGINT AS san_has_punycode, foreign_letter::BIGINT AS subject_has_homoglyphs,
  round(similarity, 6) AS max_brand_similarity,
  (similarity > 0.7 AND similarity < 1)::BIGINT AS is_brand_typosquatting,
  coalesce(len(list_filter({_list(k.REPUTABLE_ISSUERS)}, lambda x: contains(
    lower(CASE WHEN self_signed THEN concat(coalesce(cn, ''), ' ', org, ' ', n_name)
      ELSE concat('US Issuing Org ', ca) END), x))) > 0, false)::BIGINT AS issuer_is_reputable,
  self_signed::BIGINT AS is_self_signed,
  array_to_string(list_filter({_list(k.BRANDS)}, lambda x: contains(cnl, x)), '|') AS brand_exact
FROM feat""",
    "host_brand_distance": f"""WITH h AS (
  SELECT page_id, lower(regexp_extract(url, 'https?://([^./]+)', 1)) AS name FROM pages),
x AS (SELECT page_id, name, unnest({_list(k.BRANDS)}) AS brand FROM h),
s AS (SELECT *, 1 - levenshtein(name, brand) / greatest(length(name), length(brand)) AS sim FROM x)
SELECT page_id, name, brand, round(sim, 6) AS similarity FROM s
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY sim DESC, brand DESC) = 1""",
    "issuer_frequency": f"""WITH {FEATURES}
SELECT k, round(issuer_frequency, 6) AS issuer_frequency FROM feat""",
    "rules_score": f"""WITH {RULED}
SELECT k, round(rule_score, 6) AS score, array_to_string(triggered, '|') AS triggered,
  len(triggered) AS rule_count FROM ruled""",
    "rule_reasons": f"WITH {RULED} SELECT k, array_to_string(reasons, '|') AS reasons FROM ruled",
    "rule_hit_counts": f"""WITH {RULED},
cat AS (SELECT * FROM (VALUES {", ".join(
        f"({i + 1}, '{n}', {w}::DOUBLE)" for i, (n, w, _, _) in enumerate(k.RULE_TABLE))}) t(position, rule, weight)),
hits AS (SELECT rule, count(*) AS hits FROM (SELECT unnest(triggered) AS rule FROM ruled) GROUP BY rule)
SELECT position::BIGINT AS position, rule, weight, coalesce(hits, 0)::BIGINT AS hits FROM cat LEFT JOIN hits USING (rule)""",
    "ensemble": f"""WITH {SCORED}
SELECT k, round(final_score, 6) AS final_score, CASE WHEN final_score >= 0.5 THEN 'phishing' ELSE 'benign' END AS label,
  CASE WHEN final_score >= 0.8 OR final_score <= 0.3 THEN 'high' ELSE 'medium' END AS confidence,
  round(rule_score, 6) AS rules, round(ml, 6) AS ml, CASE WHEN llm_label IS NOT NULL THEN round(llm, 6) END AS llm,
  coalesce(cn, '') AS subject_cn, coalesce(CASE WHEN self_signed THEN cn ELSE ca END, '') AS issuer, 0::BIGINT AS sans
FROM verdicts""",
    "ensemble_reasons": f"""WITH {SCORED},
r AS (
  SELECT k, list_concat(
    list_transform(triggered, lambda x: '[RULE] ' || x), ['[RULE] ' || reasons[1]],
    CASE WHEN ml > 0.7 THEN [printf('[ML] High ML model confidence: %.2f', ml)] ELSE []::VARCHAR[] END,
    CASE WHEN llm_label = 'phishing' THEN [printf('[LLM] Classified as phishing (confidence: %s)', t),
        '[LLM] flag one', '[LLM] flag two', '[LLM] flag three']
      WHEN llm_label = 'benign' THEN [printf('[LLM] Classified as benign (confidence: %s)', t)]
      ELSE []::VARCHAR[] END) AS l
  FROM (SELECT *, ['0.00', '0.13', '0.25', '0.38', '0.50', '0.63', '0.75'][k % 7 + 1] AS t FROM verdicts))
SELECT k, array_to_string(l[1:10], '|') AS reasons FROM r""",
    "threshold_counts": f"""WITH {SCORED}
SELECT count(*) AS processed, count(*) FILTER (final_score >= 0.6) AS at_threshold FROM verdicts""",
    "redact_text": r"""SELECT doc_id, md5(regexp_replace(regexp_replace(text,
  '\b(?:\d{1,3}\.){3}\d{1,3}\b', '[REDACTED_IP]', 'g'),
  '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b', '[REDACTED_EMAIL]', 'g')) AS text_md5 FROM documents""",
    "redact_certificates": f"""WITH {PROPS}
SELECT k, has_peer::BIGINT AS ips, has_peer::BIGINT AS emails, org FROM props""",
    "confusion": f"""WITH {LABELLED}
SELECT tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives FROM cm""",
    "basic_metrics": f"""WITH {LABELLED}
SELECT round({_share("tn + tp", "tn + fp + fn + tp")}, 6) AS accuracy, round({_share("tp", "tp + fp")}, 6) AS precision,
  round({_share("tp", "tp + fn")}, 6) AS recall, round({_share("2 * tp", "2 * tp + fp + fn")}, 6) AS f1_score,
  round({_share("fp", "fp + tn")}, 6) AS false_positive_rate, round({_share("fn", "fn + tp")}, 6) AS false_negative_rate,
  tn + fp + fn + tp AS total_samples, tp + fn AS positive_samples, tn + fp AS negative_samples FROM cm""",
    "class_report": f"""WITH {LABELLED},
c AS (
  SELECT '0' AS class, {_share("tn", "tn + fn")} AS p, {_share("tn", "tn + fp")} AS r,
    {_share("2 * tn", "2 * tn + fn + fp")} AS f, tn + fp AS n FROM cm
  UNION ALL SELECT '1', {_share("tp", "tp + fp")}, {_share("tp", "tp + fn")},
    {_share("2 * tp", "2 * tp + fp + fn")}, tp + fn FROM cm),
a AS (
  SELECT * FROM c
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(n)::BIGINT FROM c
  UNION ALL SELECT 'weighted avg', sum(p * n) / sum(n), sum(r * n) / sum(n), sum(f * n) / sum(n), sum(n)::BIGINT FROM c)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score, n AS support FROM a""",
    "ranking_metrics": f"""WITH {LABELLED}, src AS (SELECT 1 AS one, y, score FROM rows), {_ranking("src", "one")}
SELECT round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM rank_m""",
    "threshold_sweep": f"""WITH {LABELLED},
t AS (SELECT unnest({list(k.SWEEP_THRESHOLDS)})::DOUBLE AS threshold),
x AS (
  SELECT threshold, count(*) AS n, count(*) FILTER (y = 1 AND score >= threshold) AS tp,
    count(*) FILTER (y = 0 AND score >= threshold) AS fp, count(*) FILTER (y = 1 AND score < threshold) AS fn
  FROM rows CROSS JOIN t GROUP BY threshold)
SELECT threshold, round({_share("tp", "tp + fp")}, 6) AS precision, round({_share("tp", "tp + fn")}, 6) AS recall,
  round({_share("2 * tp", "2 * tp + fp + fn")}, 6) AS f1, round((n - fp - fn) / n, 6) AS accuracy FROM x""",
    "report_summary": f"""WITH {LABELLED}
SELECT printf('%.2f%%', 100 * {_share("tn + tp", "tn + fp + fn + tp")}) AS accuracy,
  printf('%.2f%%', 100 * {_share("tp", "tp + fp")}) AS precision,
  printf('%.2f%%', 100 * {_share("tp", "tp + fn")}) AS recall,
  printf('%.2f%%', 100 * {_share("2 * tp", "2 * tp + fp + fn")}) AS f1_score FROM cm""",
    "method_comparison": f"""{METHODS},
long AS (
  SELECT 'rules' AS method, y, round(r, 9) AS score FROM m UNION ALL SELECT 'ml', y, m FROM m
  UNION ALL SELECT 'llm', y, l FROM m
  UNION ALL SELECT 'ensemble', y, round(0.25::DOUBLE * r + 0.35::DOUBLE * m + 0.4::DOUBLE * l, 9) FROM m),
cm AS (
  SELECT method, count(*) FILTER (y = 0 AND score < 0.5) AS tn, count(*) FILTER (y = 0 AND score >= 0.5) AS fp,
    count(*) FILTER (y = 1 AND score < 0.5) AS fn, count(*) FILTER (y = 1 AND score >= 0.5) AS tp
  FROM long GROUP BY method),
{_ranking("long", "method")}
SELECT method, round({_share("tn + tp", "tn + fp + fn + tp")}, 6) AS accuracy,
  round({_share("tp", "tp + fp")}, 6) AS precision, round({_share("tp", "tp + fn")}, 6) AS recall,
  round({_share("2 * tp", "2 * tp + fp + fn")}, 6) AS f1_score, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc
FROM cm JOIN rank_m USING (method)""",
    "weight_search": f"""{METHODS},
grid AS (
  SELECT a / 10 AS w_rules, b / 10 AS w_ml, (10 - a - b) / 10 AS w_llm
  FROM range(11) x(a), range(11) z(b) WHERE a + b <= 10),
cm AS (
  SELECT w_rules, w_ml, w_llm, count(*) FILTER (y = 0 AND s < 0.5) AS tn, count(*) FILTER (y = 0 AND s >= 0.5) AS fp,
    count(*) FILTER (y = 1 AND s < 0.5) AS fn, count(*) FILTER (y = 1 AND s >= 0.5) AS tp
  FROM (SELECT y, w_rules, w_ml, w_llm, round(w_rules * r + w_ml * m + w_llm * l, 12) AS s FROM m, grid)
  GROUP BY ALL)
SELECT w_rules, w_ml, w_llm, round({_share("2 * tp", "2 * tp + fp + fn")}, 6) AS f1_score,
  round((tn + tp) / (tn + fp + fn + tp), 6) AS accuracy FROM cm""",
    "weight_search_fine": f"""{METHODS},
tuples AS (SELECT y, r, m, l, count(*) AS n FROM m GROUP BY ALL),
grid AS (
  SELECT a / 100 AS w_rules, b / 100 AS w_ml, (100 - a - b) / 100 AS w_llm
  FROM range(101) x(a), range(101) z(b) WHERE a + b <= 100),
cm AS (
  SELECT w_rules, w_ml, w_llm, coalesce(sum(n) FILTER (y = 0 AND s < 0.5), 0) AS tn, coalesce(sum(n) FILTER (y = 0 AND s >= 0.5), 0) AS fp,
    coalesce(sum(n) FILTER (y = 1 AND s < 0.5), 0) AS fn, coalesce(sum(n) FILTER (y = 1 AND s >= 0.5), 0) AS tp
  FROM (SELECT y, n, w_rules, w_ml, w_llm, round(w_rules * r + w_ml * m + w_llm * l, 12) AS s FROM tuples, grid)
  GROUP BY ALL)
SELECT round({_share("2 * tp", "2 * tp + fp + fn")}, 6) AS f1_score, round((tn + tp) / (tn + fp + fn + tp), 6) AS accuracy,
  count(*) AS points FROM cm GROUP BY 1, 2 ORDER BY f1_score DESC, accuracy DESC LIMIT 20""",
    "prompt_build": f"""WITH {PROPS}
SELECT k, cn, CASE WHEN self_signed THEN cn ELSE ca END AS issuer_cn,
  CASE WHEN date_form <> 'mixed' THEN days::BIGINT END AS days, bits::BIGINT AS bits,
  concat('capture-', k) AS file_name, true AS has_examples FROM props""",
    "response_parse": f"""WITH a AS (
  SELECT conv_id, turn, text, (conv_id + turn) % 7 AS kind,
    CASE WHEN turn % 2 = 0 THEN 'phishing' ELSE 'benign' END AS label, round((conv_id % 100) / 100, 2) AS conf
  FROM conversations)
SELECT conv_id, turn, CASE WHEN kind IN (4, 6) THEN 'unknown' ELSE label END AS label,
  CASE WHEN kind IN (4, 6) THEN 0.5 WHEN kind = 5 THEN 1.0 ELSE conf END AS confidence,
  md5(CASE WHEN kind IN (0, 1, 2) THEN text WHEN kind = 3 THEN 'plain words' WHEN kind = 5 THEN ''
    ELSE 'Failed to parse LLM response' END) AS reasoning_md5,
  CASE WHEN kind IN (0, 1, 2) THEN 2 ELSE 0 END::BIGINT AS flags, kind IN (4, 6) AS parse_error FROM a""",
    "response_dedup": f"""WITH {PROPS}
SELECT ca AS cn, n_name AS country, year(o_orderdate)::VARCHAR AS year, count(*) AS n_copies
FROM props GROUP BY ALL""",
    "response_scoring": f"""WITH {PROPS}
SELECT k, CASE WHEN ca = 'DigiCert Inc' THEN 'benign' ELSE 'phishing' END AS label, 'stand-in' AS model,
  CASE WHEN ca = 'DigiCert Inc' THEN 0.25 ELSE 0.75 END::DOUBLE AS score FROM props""",
    "response_resume": f"""WITH {PROPS}
SELECT k, CASE WHEN n_name < 'B' THEN 'phishing' WHEN n_name < 'E' THEN 'unknown' WHEN n_name < 'K' THEN 'benign'
    WHEN ca = 'DigiCert Inc' THEN 'benign' ELSE 'phishing' END AS label,
  CASE WHEN n_name < 'B' THEN 'later' WHEN n_name < 'E' THEN NULL WHEN n_name < 'K' THEN 'earlier' ELSE 'stand-in' END AS model,
  CASE WHEN n_name >= 'B' AND n_name < 'E' THEN 'down' END AS error,
  CASE WHEN n_name < 'B' THEN 1 WHEN n_name < 'K' THEN 0.5 WHEN ca = 'DigiCert Inc' THEN 0.25 ELSE 0.75 END::DOUBLE AS score
FROM props""",
    "term_counts": f"""WITH w AS (SELECT doc_id, unnest({_WORDS}) AS term FROM documents)
SELECT term, count(*) AS occurrences, count(DISTINCT doc_id) AS documents FROM w GROUP BY term""",
    "ngram_stats": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (
  SELECT doc_id, 1 AS words, unnest(w) AS term FROM d
  UNION ALL SELECT doc_id, 2, unnest(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) FROM d
  UNION ALL SELECT doc_id, 3, unnest(list_transform(range(1, len(w) - 1),
    lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))) FROM d),
t AS (SELECT words, term, count(*) AS n, count(DISTINCT doc_id) AS docs FROM g GROUP BY ALL HAVING docs >= 2)
SELECT words::BIGINT AS words, count(*) AS terms, sum(n)::BIGINT AS occurrences, max(docs) AS max_documents
FROM t GROUP BY words""",
    "top_terms": f"""WITH {_GRAMS}
SELECT position, term, occurrences, documents, round(idf, 6) AS idf FROM top""",
    "tfidf_weights": f"""WITH {_GRAMS}
SELECT doc_id, term, n, round(n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY doc_id)), 6) AS weight
FROM counted JOIN top USING (term)""",
    "scaled_numbers": f"""WITH {SCALED}
SELECT k, {", ".join(f"round(x{i}, 6) AS {name}" for i, name in enumerate(_NAMES, 1))} FROM z""",
    "logistic_fit": f"""WITH RECURSIVE {FIT}
SELECT unnest({_list(("intercept", *_NAMES))}) AS feature, round(unnest([{", ".join(f"w{i}" for i in range(_N))}]), 6) AS coefficient,
  (SELECT count(*) FROM z) AS samples, (SELECT sum(y)::BIGINT FROM z) AS positive_samples FROM last""",
    "predicted_labels": f"""WITH RECURSIVE {FIT},
p AS (SELECT k, 1 / (1 + exp(-(w0 + {" + ".join(f"w{i} * x{i}" for i in range(1, _N))}))) AS p FROM z, last)
SELECT k, round(p, 6) AS probability, (p > 0.5)::BIGINT AS label FROM p""",
    "similar_vectors": """WITH m AS (
  SELECT label, i, avg(x) AS m FROM (
    SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
  GROUP BY label, i),
c AS (SELECT label AS class, list(m ORDER BY i) AS v FROM m GROUP BY label),
s AS (
  SELECT class, vec_id, list_cosine_similarity(embedding::DOUBLE[], v) AS sim FROM embeddings CROSS JOIN c),
r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY sim DESC, vec_id) AS rank FROM s)
SELECT class AS label, rank, vec_id, round(sim, 5) AS similarity FROM r WHERE rank <= 5""",
}
ORACLES["pem_decode"] = ORACLES["x509_decode"].replace(
    "1::BIGINT AS chain", "CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS chain")
