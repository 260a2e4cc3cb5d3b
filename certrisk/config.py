"""Settings of a scoring run, passed as an argument and never held globally."""

from __future__ import annotations

from dataclasses import dataclass

from certrisk import constants as k


@dataclass(frozen=True)
class RiskConfig:
    # rules
    min_validity_days: int = 7
    max_validity_days: int = 398
    min_pubkey_bits: int = 2048
    rare_issuer: float = 0.001
    # word lists
    brands: tuple[str, ...] = k.BRANDS
    reputable_issuers: tuple[str, ...] = k.REPUTABLE_ISSUERS
    suspicious_words: tuple[str, ...] = k.SUSPICIOUS_WORDS
    # ensemble
    weight_rules: float = 0.25
    weight_ml: float = 0.35
    weight_llm: float = 0.40
    phishing_threshold: float = 0.5
    high_confidence: float = 0.8
    low_confidence: float = 0.3
    # classifier
    model_type: str = "logistic"
    tfidf_terms: int = 5000
    tfidf_min_df: float = 2.0
    tfidf_max_df: float = 0.9
    max_iter: int = 1000
    boost_rounds: int = 100
    boost_depth: int = 6
    # reading
    max_capture_bytes: int = 64 << 20
    # sampling
    train_fraction: float = 0.70
    validation_fraction: float = 0.15
    seed: int = 42
    # language-model scorer
    max_retries: int = 3
    prompt_chars: int = 2000
    # retrieval
    top_k: int = 3
    # privacy
    redact_pii: bool = False

    def __post_init__(self) -> None:
        total = self.weight_rules + self.weight_ml + self.weight_llm
        if abs(total - 1.0) > 0.01:
            raise ValueError(f"ensemble weights must add up to 1, got {total}")


DEFAULT = RiskConfig()
