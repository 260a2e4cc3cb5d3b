"""Fixed values.

Everything in this module is data that results depend on: word lists, patterns,
weights, thresholds and output formats. Nothing here is computed from input.
"""

# Markers used to recognise a capture by its first bytes.
SNIFF_BYTES = 8192
PEM_BEGIN = "-----BEGIN CERTIFICATE-----"
PEM_END = "-----END CERTIFICATE-----"
TEXT_MARKERS = (
    "Certificate chain",
    "Server certificate",
    "subject=",
    "issuer=",
    "CONNECTED(",
)
MIN_ASCII_SHARE = 0.9
MIN_DER_BYTES = 100

# Patterns of the text parser (Java syntax; `[^\n]` because Java's
# dot also stops at other line terminators).
CHAIN_LINE = r"(?m)^\s*\d+\s+s:"
SUBJECT_LINE = r"(?i)subject[=:]([^\n]+?)(?:\n|issuer)"
ISSUER_LINE = r"(?i)issuer[=:]([^\n]+?)(?:\n|---)"
NOT_BEFORE_LINE = r"(?i)notBefore[=:]([^\n]+)"
NOT_AFTER_LINE = r"(?i)notAfter[=:]([^\n]+)"
KEY_BITS = r"(?i)Public[- ]Key:\s*\((\d+)\s*bit\)"
KEY_TYPE = r"(?i)Public Key Algorithm:\s*([^\n]+)"
SIGNATURE = r"(?i)Signature Algorithm:\s*([^\n]+)"
CIPHER = r"Cipher\s*:\s*([^\n]+)"
PROTOCOL = r"Protocol\s*:\s*([^\n]+)"
URL = r"https?://[^\s]+"
IP_ADDRESS = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
IP_MASK = "[REDACTED_IP]"
EMAIL_MASK = "[REDACTED_EMAIL]"

# Brand names watched for imitation.
BRANDS = (
    "google", "facebook", "amazon", "microsoft", "apple", "paypal", "netflix",
    "twitter", "instagram", "linkedin", "yahoo", "ebay", "alibaba", "baidu",
    "github", "stackoverflow", "reddit", "wikipedia", "cloudflare", "adobe",
    "salesforce", "dropbox", "spotify", "zoom", "slack", "discord",
)

# Certificate authorities counted as reputable.
REPUTABLE_ISSUERS = (
    "digicert", "lets encrypt", "comodo", "godaddy", "globalsign", "sectigo",
    "entrust", "thawte", "geotrust", "rapidssl", "symantec", "verisign",
    "google trust services", "amazon trust services", "microsoft", "apple",
)

# Words counted as suspicious in the capture text.
SUSPICIOUS_WORDS = (
    "verify", "verification", "confirm", "account", "suspend", "update",
    "secure", "alert", "urgent", "locked", "limited", "expired",
)

# The numeric inputs of the classifier, in vector order.
MODEL_COLUMNS = (
    "validity_days", "pubkey_bits", "chain_length", "san_count",
    "has_san", "parse_warning_count", "has_parse_warnings",
    "pubkey_is_rsa", "pubkey_is_ecc", "sig_is_sha256",
    "sig_is_sha1", "sig_is_md5", "subject_cn_length",
    "subject_cn_has_wildcard", "subject_cn_digit_ratio",
    "subject_has_punycode", "san_has_punycode", "subject_has_homoglyphs",
    "max_brand_similarity", "is_brand_typosquatting",
    "issuer_is_reputable", "is_self_signed", "url_count",
    "has_url", "suspicious_keyword_count", "ip_count",
    "validity_very_short", "validity_short", "validity_medium",
    "validity_standard", "validity_long", "issuer_frequency",
    "text_length", "digit_ratio", "upper_ratio",
    "special_char_ratio", "entropy", "non_ascii_ratio",
)

# Rule name, weight, reason format, description - in scoring order.
RULE_TABLE = (
    ("short_validity_period", 0.8,
     "Validity period is only %d days (suspicious, normal is 90-398 days)",
     "Validity period is suspiciously short (<7 days)"),
    ("long_validity_period", 0.6,
     "Validity period is %d days (exceeds CA/Browser Forum baseline of 398 days)",
     "Validity period exceeds CA/B Forum limit (>398 days)"),
    ("weak_public_key", 0.9,
     "Weak public key: %d bits (minimum should be %d)",
     "Public key strength below minimum (2048 bits for RSA)"),
    ("weak_signature_algorithm", 0.85,
     "Weak signature algorithm: %s (deprecated, should use SHA-256 or stronger)",
     "Uses deprecated signature algorithm (SHA-1, MD5)"),
    ("punycode_domain", 0.7,
     "Domain uses Punycode (xn--), potential homograph attack",
     "Domain uses Punycode (potential homograph attack)"),
    ("homoglyph_characters", 0.75,
     "Subject contains homoglyph characters (confusable Unicode)",
     "Contains confusable Unicode characters"),
    ("brand_typosquatting", 0.85,
     "Domain appears to typosquat a major brand (similarity: %.2f)",
     "Domain name similar to major brand (typosquatting)"),
    ("self_signed", 0.6,
     "Certificate is self-signed (not from trusted CA)",
     "Certificate is self-signed"),
    ("rare_issuer_short_validity", 0.7,
     "Rare issuer combined with short validity period",
     "Rare CA with short validity (suspicious combination)"),
    ("url_in_certificate", 0.5,
     "Certificate contains URL (unusual, may be from phishing capture)",
     "Contains URL (may be from phishing capture)"),
    ("suspicious_keywords", 0.6,
     "Contains %d suspicious keywords (verify, account, etc.)",
     "Contains multiple suspicious keywords"),
    ("missing_chain", 0.4,
     "Certificate chain is missing or incomplete",
     "Certificate chain missing or incomplete"),
    ("no_san", 0.3,
     "No Subject Alternative Names (unusual for modern certificates)",
     "No Subject Alternative Names (unusual for modern certs)"),
)

# Cut-offs of the threshold sweep.
SWEEP_THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)

# Object identifiers of the X.509 standards (RFC 5280 and friends).
NAME_OIDS = {
    "2.5.4.3": "CN",
    "2.5.4.10": "O",
    "2.5.4.11": "OU",
    "2.5.4.6": "C",
    "2.5.4.8": "ST",
    "2.5.4.7": "L",
}
SAN_OID = "2.5.29.17"
KEY_OIDS = {
    "1.2.840.113549.1.1.1": "RSA",
    "1.2.840.113549.1.1.10": "RSA",
    "1.2.840.10045.2.1": "EC",
    "1.2.840.10040.4.1": "DSA",
    "1.3.101.112": "Ed25519",
    "1.3.101.113": "Ed448",
    "1.3.101.110": "X25519",
    "1.3.101.111": "X448",
}
CURVE_BITS = {
    "1.2.840.10045.3.1.1": 192,
    "1.3.132.0.33": 224,
    "1.2.840.10045.3.1.7": 256,
    "1.3.132.0.10": 256,
    "1.3.132.0.34": 384,
    "1.3.132.0.35": 521,
    "1.3.36.3.3.2.8.1.1.7": 256,
    "1.3.36.3.3.2.8.1.1.11": 384,
    "1.3.36.3.3.2.8.1.1.13": 512,
}
SIGNATURE_OIDS = {
    "1.2.840.113549.1.1.4": "md5WithRSAEncryption",
    "1.2.840.113549.1.1.5": "sha1WithRSAEncryption",
    "1.2.840.113549.1.1.14": "sha224WithRSAEncryption",
    "1.2.840.113549.1.1.11": "sha256WithRSAEncryption",
    "1.2.840.113549.1.1.12": "sha384WithRSAEncryption",
    "1.2.840.113549.1.1.13": "sha512WithRSAEncryption",
    "1.2.840.113549.1.1.10": "RSASSA-PSS",
    "1.2.840.10045.4.1": "ecdsa-with-SHA1",
    "1.2.840.10045.4.3.1": "ecdsa-with-SHA224",
    "1.2.840.10045.4.3.2": "ecdsa-with-SHA256",
    "1.2.840.10045.4.3.3": "ecdsa-with-SHA384",
    "1.2.840.10045.4.3.4": "ecdsa-with-SHA512",
    "1.2.840.10040.4.3": "dsa-with-sha1",
    "2.16.840.1.101.3.4.3.2": "dsa-with-sha256",
    "1.3.101.112": "ed25519",
    "1.3.101.113": "ed448",
}
