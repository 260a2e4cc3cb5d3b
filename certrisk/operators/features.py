"""The feature columns of a parsed certificate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certrisk.config import DEFAULT, RiskConfig
from certrisk.functions import text as tx
from certrisk.functions.names import sorted_entries
from certrisk.session import staged


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def _number(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def structural() -> dict[str, Column]:
    n_san = F.coalesce(F.size("san"), F.lit(0))
    n_warnings = F.coalesce(F.size("parse_warnings"), F.lit(0))
    key_type = F.lower("pubkey_type")
    signature = F.lower("signature_algorithm")
    return {
        "validity_days": _number(F.col("validity_days")),
        "pubkey_bits": _number(F.col("pubkey_bits")),
        "chain_length": _number(F.col("chain_length")),
        "san_count": n_san,
        "has_san": _flag(n_san > 0),
        "parse_warning_count": n_warnings,
        "has_parse_warnings": _flag(n_warnings > 0),
        "pubkey_is_rsa": _flag(F.contains(key_type, F.lit("rsa"))),
        "pubkey_is_ecc": _flag(F.contains(key_type, F.lit("ec"))),
        "sig_is_sha256": _flag(F.contains(signature, F.lit("sha256"))),
        "sig_is_sha1": _flag(F.contains(signature, F.lit("sha1"))),
        "sig_is_md5": _flag(F.contains(signature, F.lit("md5"))),
    }


def lexical() -> dict[str, Column]:
    """Needs the text steps; NULL for an empty text."""
    t = F.col("_text")
    counts = tx.character_counts()
    return {
        "text_length": F.length(t),
        "digit_count": counts["digit"],
        "digit_ratio": tx.ratio(counts["digit"], t),
        "upper_count": counts["upper"],
        "upper_ratio": tx.ratio(counts["upper"], t),
        "special_char_count": counts["special"],
        "special_char_ratio": tx.ratio(counts["special"], t),
        "entropy": tx.entropy(t),
        "non_ascii_count": counts["non_ascii"],
        "non_ascii_ratio": tx.ratio(counts["non_ascii"], t),
    }


def statistical(config: RiskConfig = DEFAULT) -> dict[str, Column]:
    """Needs the text steps; NULL for an empty text."""
    return {
        "url_count": F.col("_urls"),
        "has_url": (F.col("_urls") > 0).cast("int"),
        "suspicious_keyword_count": tx.count_contained(F.col("_lower"), config.suspicious_words),
        "ip_count": tx.ip_count(F.col("_text")),
    }


def has_homoglyphs(c: Column) -> Column:
    """A Greek or Cyrillic letter."""
    return F.rlike(c, F.lit("[\\u0370-\\u03FF\\u0400-\\u04FF]"))


def brand_hits(name: Column, brands: tuple[str, ...]) -> Column:
    """Brands contained in a lower-cased name."""
    return F.filter(F.array(*map(F.lit, brands)), lambda b: F.contains(name, b))


def brand_distance_score(name: Column, brand: Column) -> Column:
    """1 for containment, else the edit similarity where it can exceed 0.7, else NULL.

    The length difference bounds the distance from below, so most pairs are
    settled without computing it.
    """
    longest = F.greatest(F.length(name), F.length(brand))
    gap = F.abs(F.length(name) - F.length(brand))
    return (F.when(F.contains(name, brand), F.lit(1.0))
            .when(gap * 10 < longest * 3, 1 - F.levenshtein(name, brand) / longest))


def brand_similarity(name: Column, brands: tuple[str, ...]) -> Column:
    """Best similarity of a lower-cased name to any brand; 0 when none exceeds 0.7."""
    scores = F.transform(F.array(*map(F.lit, brands)), lambda b: brand_distance_score(name, b))
    return F.coalesce(F.array_max(F.filter(scores, lambda s: s > 0.7)), F.lit(0.0))


def identity(config: RiskConfig = DEFAULT) -> dict[str, Column]:
    """Needs the helper columns of :func:`add_helpers`."""
    cn, lowered = F.col("_cn"), F.col("_cn_lower")
    similarity = F.col("_similarity")
    return {
        "subject_cn_length": F.length(cn),
        "subject_cn_has_wildcard": _flag(F.contains(cn, F.lit("*"))),
        "subject_cn_digit_ratio": tx.ratio(tx.digit_count(cn), cn),
        "subject_has_punycode": _flag(F.contains(lowered, F.lit("xn--"))),
        "san_has_punycode": _flag(F.exists("san", lambda s: F.contains(F.lower(s), F.lit("xn--")))),
        "subject_has_homoglyphs": _flag(has_homoglyphs(cn)),
        "max_brand_similarity": similarity,
        "is_brand_typosquatting": _flag((similarity > 0.7) & (similarity < 1.0)),
        "issuer_is_reputable": _flag(
            tx.contains_any(F.col("_issuer_lower"), config.reputable_issuers)),
        "is_self_signed": _flag(
            (sorted_entries(F.col("subject")) == sorted_entries(F.col("issuer")))
            & (F.size("subject") > 0)),
        "brand_exact": brand_hits(lowered, config.brands),
    }


def temporal() -> dict[str, Column]:
    days = _number(F.col("validity_days"))
    return {
        "validity_very_short": _flag((days > 0) & (days < 7)),
        "validity_short": _flag((days >= 7) & (days < 30)),
        "validity_medium": _flag((days >= 30) & (days < 90)),
        "validity_standard": _flag((days >= 90) & (days <= 398)),
        "validity_long": _flag(days > 398),
    }


def add_helpers(df: DataFrame, config: RiskConfig = DEFAULT) -> DataFrame:
    """Values several features share, computed once per row."""
    df = df.withColumn("_cn", F.coalesce(F.try_element_at("subject", F.lit("CN")), F.lit("")))
    df = df.withColumns({
        "_cn_lower": F.lower("_cn"),
        "_issuer_lower": F.lower(F.array_join(F.map_values("issuer"), " "))})
    return df.withColumn("_similarity", brand_similarity(F.col("_cn_lower"), config.brands))


def _flat_features(
    df: DataFrame, config: RiskConfig, keep_text: bool, names: tuple[str, ...] | None,
) -> tuple[DataFrame, list[str]]:
    """One column ``_f_<name>`` per feature (all, or those of ``names``), and the features in their order."""
    columns = {
        **structural(), **lexical(), **identity(config), **statistical(config), **temporal()}
    if names is not None:
        columns = {n: c for n, c in columns.items() if n in names}
    out = add_helpers(tx.with_text_steps(df, "raw_text"), config)
    out = out.withColumns({f"_f_{n}": c for n, c in columns.items()})
    out = out.drop("_cn", "_cn_lower", "_issuer_lower", "_similarity", *tx.TEXT_STEPS)
    return (out if keep_text else out.drop("raw_text", "pem")), list(columns)


def _with_struct(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumn("features", F.struct(
        *[F.col(f"_f_{n}").alias(n) for n in names], F.col("issuer_frequency"))
    ).drop(*[f"_f_{n}" for n in names], "issuer_frequency")


def add_features(
    df: DataFrame, frequencies: DataFrame | None = None, config: RiskConfig = DEFAULT,
    keep_text: bool = True, names: tuple[str, ...] | None = None,
) -> DataFrame:
    """Add a ``features`` struct to parsed certificates; ``names`` are the features wanted, all by default.

    ``frequencies`` is the fitted issuer table; without it ``issuer_frequency``
    stays NULL. ``keep_text=False`` drops the capture text before the issuer
    join, so that wide rows never enter a shuffle.
    """
    from certrisk.operators.issuers import add_issuer_frequency

    # Flat until the end, so that columns nobody asks for are pruned below the join.
    out, found = _flat_features(df, config, keep_text, names)
    return _with_struct(add_issuer_frequency(out, frequencies), found)


def add_fitted_features(
    df: DataFrame, keep: tuple[str, ...], names: tuple[str, ...] | None = None, config: RiskConfig = DEFAULT,
) -> DataFrame:
    """``keep`` (with ``path``) and ``features`` of parsed certificates, their issuer table fitted on themselves.

    The table needs every row before the first feature row can be finished. So the flat features are staged, without the
    text, and the issuers counted and looked up there: the text is parsed once.
    """
    from certrisk.operators.issuers import add_keyed, fit_keyed, with_issuer_key

    out, found = _flat_features(df, config, False, names)
    kept = dict.fromkeys(["path", *keep])
    rows = staged(with_issuer_key(out).select(*kept, "issuer_key", *[f"_f_{n}" for n in found]), "flat-features")
    return _with_struct(add_keyed(rows, fit_keyed(rows)), found).select(*kept, "features")


def extract_features(
    df: DataFrame, fit: bool = True, frequencies: DataFrame | None = None,
    config: RiskConfig = DEFAULT,
) -> DataFrame:
    """Flat feature table of a corpus, fitting the issuer table on it when asked."""
    from certrisk.operators.issuers import fit_issuer_frequencies

    if fit and frequencies is None:
        frequencies = fit_issuer_frequencies(df)
    return add_features(df, frequencies, config, keep_text=False).select(
        "path", "file_name", "label", "features.*")
