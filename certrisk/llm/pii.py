"""Personal data: patterns for what has a fixed form, and a trained character tagger beside them.

The tagger (``tagger.py``) sees every stretch of text around a trigger (``_TRIGGER``), one of which
all its kinds contain, in overlapping windows. What the windows of a text say is put
together for the whole text: of overlapping spans the one furthest from the edges of
its window stays. Spans of the patterns always stay; a span of the tagger is added where it
touches none of them and has the makings of its kind (see ``plausible``). Beyond the kinds of the
patterns, and phone numbers without ``+``, it finds keys and passwords by the words before them, and
addresses written out. Both have exact edges once found: a key is a run of 12 to 512 of its characters, an
address what has the form of one inside the tagger's span.

The tagger is trained from labelled spans: pieces of at most ``sample_chars`` characters from a
bounded sample of the documents (``sample_documents``) carry the spans that the patterns find in
them, and generated ones at known places. No more than that reaches the driver.

Defined results: a null or empty text has no spans; rows with equal ids are handled each
on its own; a table without rows gives no rows (the tagger is then trained on generated
text alone); offsets are code points, the end excluded.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certrisk.llm.common import bounded_batches, unused
from certrisk.llm.tagger import EXAMPLE, KINDS, STEP, WINDOW, Tagger, spans_of, symbols, train

Span = tuple[str, int, int]
SPANS = "array<struct<kind:string,start:long,end:long,source:string>>"

# The forms of the four kinds.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TRIGGER = re.compile(r"[0-9@+]|[=:]\x20?[\"']|[(\[][Aa][Tt][)\]]|\x20[Dd][Oo][Tt]\x20")
_KEY = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_KEY_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_AT, _DOT = r"(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20)", r"(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)"
_ADDRESS = re.compile(rf"[a-z0-9_+-]+(?:(?:\.|{_DOT})[a-z0-9_+-]+)*{_AT}[a-z0-9-]+(?:(?:\.|{_DOT})[a-z0-9-]+)*{_DOT}[a-z]{{2,6}}", re.I)
#: Words of the documents that may be personal data without a label; examples go without them.
_UNKNOWN = re.compile(r"[^\s0-9@]*[0-9@]\S*")
#: Shares of the generated spans by kind: keys, told by their surroundings alone, need the most examples.
WEIGHTS = (1, 1, 1, 1, 4, 2)
# How keys of common services begin.
NAMED = ("AKIA", "ASIA", "ghp_", "sk-")
#: Length of a key, least and most.
KEY_SIZE = (12, 512)

#: Windows decoded at a time.
LANES = 512
#: Characters looked at before and after a trigger.
REACH = 40


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """All starts of a run before ``@`` share its end, so each ``@`` is tried once."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            free = found.end()
        at = text.find("@", max(at + 1, free))
    return out


def digits_in(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def pattern_spans(text: str) -> list[Span]:
    """Spans by pattern, by kind and then by start."""
    out = _emails(text) if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = digits_in(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_in(m.group())) <= 15]
    return out


def plausible(kind: str, whole: str, start: int, end: int) -> bool:
    """What the tagger's span must have: whole words around it, and the parts of its kind."""
    if whole[start - 1:start].isalnum() or whole[end:end + 1].isalnum():
        return False
    text = whole[start:end]
    digits = digits_in(text)
    if kind == "email":
        return bool(re.search(r"[^\s@]@[^\s@]", text)) and not re.search(r"\s", text)
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(re.fullmatch("[0-9]{1,3}", p) and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "secret":
        return (KEY_SIZE[0] <= len(text) <= KEY_SIZE[1] and bool(digits) and len(digits) < len(text)
                and bool(_KEY.fullmatch(text)))
    if kind == "address":
        return bool(_ADDRESS.fullmatch(text))
    groups = len(re.findall("[0-9]+", text))
    return (8 <= len(digits) <= 15 and not re.search(r"[^0-9 ().+-]", text)
            and (text[0] == "+" or groups >= 3))


def whole_key(text: str, start: int, end: int) -> tuple[int, int]:
    """The run of a key's characters around a place; runs beyond the most stay too long to be one."""
    low, high = max(0, start - KEY_SIZE[1]), min(len(text), end + KEY_SIZE[1])
    while start > low and text[start - 1] in _KEY_CHARS:
        start -= 1
    while end < high and text[end] in _KEY_CHARS:
        end += 1
    while start < end and text[start] not in _KEY_CHARS:
        start += 1
    while end > start and text[end - 1] not in _KEY_CHARS and text[end - 1] != "=":
        end -= 1
    return start, end


def window_starts(text: str) -> list[int]:
    """Windows that cover every trigger with its surroundings, overlapping by half."""
    starts, covered = [], -1
    for m in _TRIGGER.finditer(text):
        if m.start() + REACH <= covered:
            continue
        start = max(0, m.start() - REACH)
        if starts and start < covered:
            start = starts[-1] + STEP
        starts.append(start)
        covered = start + WINDOW
    return starts


def reconciled(found: list[tuple[int, str, int, int]]) -> list[Span]:
    """Of overlapping spans keep the one furthest from its window's edges (``margin`` first)."""
    taken: list[Span] = []
    for _, kind, start, end in sorted(found, key=lambda x: (-x[0], x[2], x[3], x[1])):
        if all(end <= s or start >= e for _, s, e in taken):
            taken.append((kind, start, end))
    return taken


def tagged_spans(tagger: Tagger, texts: list[str]) -> list[list[Span]]:
    """What the tagger finds in each text."""
    places = [(k, s) for k, text in enumerate(texts) for s in window_starts(text)]
    coded: dict[int, np.ndarray] = {}
    found: list[list] = [[] for _ in texts]
    for at in range(0, len(places), LANES):
        lanes = places[at:at + LANES]
        rows = np.zeros((len(lanes), WINDOW), np.int64)
        for row, (k, s) in zip(rows, lanes):
            if k not in coded:
                coded = {k: symbols(texts[k])}  # windows come text by text
            part = coded[k][s:s + WINDOW]
            row[:len(part)] = part
        for (k, s), tags in zip(lanes, tagger.decode(rows)):
            size = len(texts[k])
            for kind, a, b in spans_of(tags):
                start, end = s + a, min(s + b, size)
                left = a if s else WINDOW
                right = WINDOW - b if s + WINDOW < size else WINDOW
                if kind == "secret":
                    start, end = whole_key(texts[k], start, end)
                elif kind == "address" and (form := _ADDRESS.search(texts[k], start, end)):
                    start, end = form.span()  # the words beside it are often taken along
                if start < end and plausible(kind, texts[k], start, end):
                    found[k].append((min(left, right), kind, start, end))
    return [reconciled(x) for x in found]


def all_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[str, int, int, str]]]:
    out = []
    for text, more in zip(texts, tagged_spans(tagger, texts)):
        base = pattern_spans(text)
        mine = [x for x in more if all(x[2] <= s or x[1] >= e for _, s, e in base)]
        both = [(*x, "pattern") for x in base] + [(*x, "tagger") for x in mine]
        out.append(sorted(both, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))
    return out


def _generated(rng: random.Random, kind: str) -> str:
    letters = "abcdefghijklmnopqrstuvwxyz"

    def word(low: int, high: int) -> str:
        return "".join(rng.choices(letters, k=rng.randint(low, high)))

    def number(low: int, high: int) -> str:
        return "".join(rng.choices("0123456789", k=rng.randint(low, high)))

    if kind == "email":
        name = rng.choice([word(3, 9), f"{word(2, 7)}.{word(3, 8)}", f"{word(2, 6)}{number(1, 3)}", f"{word(1, 4)}.{number(1, 3)}"])
        return f"{name}@{word(3, 9)}.{rng.choice(['com', 'org', 'net', 'example.com', 'co'])}"
    if kind == "ip":
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        body = rng.choice("3456") + number(14, 14)
        body += next(d for d in "0123456789" if luhn(body + d))
        gap = rng.choice(["", " ", "-"])
        return gap.join(body[i:i + 4] for i in range(0, 16, 4))
    if kind == "secret":
        form = rng.choice(["hex", "hex", "mixed", "mixed", "named"])
        if form == "named":
            name = rng.choice(NAMED)
            return name + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + letters * (not name.isupper()), k=rng.randint(16, 30))) + number(1, 1)
        if form == "hex":
            return "".join(rng.choices("0123456789abcdef", k=rng.choice([32, 40, rng.randint(12, 24), rng.randint(16, 56)])))
        letters += letters.upper() + "0123456789"
        value = word(12, 44)
        return value if any(c.isdigit() for c in value) else value + number(1, 2)
    if kind == "address":
        at, dot = rng.choice([(" at ", " dot "), (" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" (at) ", " dot ")])
        name = rng.choice([word(3, 9), f"{word(2, 6)}.{word(3, 7)}", f"{word(2, 6)}{number(1, 3)}", f"{word(3, 6)}{dot}{word(3, 6)}"])
        return f"{name}{at}{word(3, 9)}{dot}{rng.choice(['com', 'org', 'net', 'de', 'io'])}"
    gap = rng.choice([" ", "-", "."])
    return rng.choice(["+", "+", "+", ""]) + f"{rng.randint(1, 99)}{gap}{number(3, 3)}{gap}{number(3, 3)}{gap}{number(3, 4)}"


def _before(rng: random.Random, kind: str, value: str) -> str:
    """What stands before a value; a key is told by the word that names it, or by how it begins."""
    if kind != "secret" or (value.startswith(NAMED) and rng.random() < 0.6):
        return rng.choice([" ", "\n", ": ", " ("])
    name = rng.choice(["token", "token", "api_key", "key", "secret", "password", "passwd", "access_token", "client_secret", "auth"])
    name = rng.choice([name, name, name.upper(), name.capitalize(), f"my_{name}"])
    return " " + name + rng.choice([" = ", "=", ": ", ":"]) + rng.choice(['"', '"', "'", ""])


def _distractor(rng: random.Random) -> str:
    digits = "".join(rng.choices("0123456789", k=rng.randint(1, 6)))
    words = ["look", "the", "polka", "here", "on", "line", "size", "name", "title", "color", "mean", "place"]
    value = "".join(rng.choices("0123456789abcdef", k=rng.randint(12, 40)))
    return rng.choice([
                       f'{rng.choice(["commit", "id", "sha", "name", "etag", "build", "ref"])} {rng.choice(["= ", "", ": "])}{rng.choice(["", chr(34)])}{value}',
                       f'{rng.choice(words)} = "{rng.choice(words)} {rng.choice(words)}"', f"{rng.choice(words)} at the {rng.choice(words)} dot {rng.choice(words)}",
                       f"token {rng.choice(words)}", f'key: "{rng.choice(words)}"',
                       digits, "".join(rng.choices("0123456789", k=rng.randint(9, 20))), f"v{digits[:1]}.{digits[-1:]}", f"{digits[:2]}.{digits}", f"a{digits}f{digits[:1]}", f"+{digits[:2]}",
                       "@" + digits[:1], "".join(rng.choices("0123456789abcdef", k=rng.randint(16, 40))),
                       f"{digits[:2]}/{digits[:1]}/20{digits[:2]}"])


def labelled_windows(texts: list[str], size: int = 1200, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Training windows: pieces of the texts with the spans of the patterns, generated spans
    at known places, and numbers that mean nothing."""
    rng = random.Random(seed)
    texts = [t for t in texts if t] or ["plain words without any number. And some more of them, here."]
    out: list[tuple[str, list[Span]]] = []
    for text in texts:
        for kind, start, end in pattern_spans(text)[:4]:
            s = max(0, start - rng.randint(0, 30))
            piece = text[s:s + EXAMPLE]
            spans = pattern_spans(piece)
            if all(any(a < m.end() and b > m.start() for _, a, b in spans) for m in _UNKNOWN.finditer(piece)):
                out.append((piece, spans))
    out = out[:size // 3]
    while len(out) < size:
        text = rng.choice(texts)
        s = rng.randrange(max(1, len(text) - 30))
        piece, spans = _UNKNOWN.sub("", text[s:s + rng.randint(3, 25)]), []
        for _ in range(rng.choice([0, 1, 1, 1, 1, 2])):
            if rng.random() < 0.6:
                kind, = rng.choices(KINDS, WEIGHTS)
                value = _generated(rng, kind)
                piece += _before(rng, kind, value)
                spans.append((kind, len(piece), len(piece) + len(value)))
            else:
                value = _distractor(rng)
                piece += " "
            piece += value + (piece[-1] if piece[-1] in "\"'" else "") + rng.choice([" ", ", ", ". ", "\n", ")"])
        piece += _UNKNOWN.sub("", text[s:s + rng.randint(0, 30)])
        out.append((piece[:EXAMPLE], [(k, a, min(b, EXAMPLE)) for k, a, b in spans if a < EXAMPLE]))
    return out


def sampled_texts(docs: DataFrame, sample_documents: int, sample_chars: int) -> list[str]:
    """Pieces of at most ``sample_documents`` texts, drawn by a hash of the row. The rows are counted
    first, so that a cut-off on the hash leaves few of them to order; equal rows count once."""
    rows = docs.filter("text IS NOT NULL").select(F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("h"))
    share = min(1.0, 4 * sample_documents / max(rows.count(), 1))
    drawn = rows.filter(F.col("h") <= F.lit(min(int((2 * share - 1) * 2 ** 63), 2 ** 63 - 1)))
    cut = drawn.select("h").distinct().orderBy("h").limit(sample_documents).agg(F.max("h")).first()[0]
    if cut is None:
        return []
    length = F.greatest(F.length("text") - F.lit(sample_chars), F.lit(0)) + 1
    piece = F.substring(F.col("text"), (F.pmod(F.col("h"), length) + 1).cast("int"), F.lit(sample_chars))
    found = drawn.filter(F.col("h") <= F.lit(cut)).select("h", piece.alias("piece")).groupBy("h").agg(F.min("piece").alias("piece"))
    return [r["piece"] for r in sorted(found.collect(), key=lambda r: (r["h"], r["piece"]))]


def fit_tagger(docs: DataFrame, sample_documents: int = 200, size: int = 1200, seed: int = 7, sample_chars: int = 4000) -> Tagger:
    """Train on pieces of at most ``sample_documents`` documents, of at most ``sample_chars`` characters each."""
    return train(labelled_windows(sampled_texts(docs, sample_documents, sample_chars), size, seed), seed=seed)


def spans_column(text: Column, tagger: Tagger) -> Column:
    """``array<struct<kind, start, end, source>>`` of a text column, by kind and start."""

    @F.arrow_udf(SPANS)
    def find(column: pa.Array) -> pa.Array:
        rows = np.flatnonzero(pc.match_substring_regex(column, _TRIGGER.pattern).fill_null(False).to_numpy(zero_copy_only=False))
        texts = column.take(pa.array(rows)).to_pylist()
        out: list[list] = [[] for _ in range(len(column))]
        for k, spans in zip(rows, all_spans(tagger, texts)):
            out[k] = [{"kind": a, "start": b, "end": c, "source": d} for a, b, c, d in spans]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("source", pa.string())]))
        return pa.array(out, kind)

    return find(text)


def masked(text: Column, spans: Column, mask: Callable[[Column], Column]) -> Column:
    """``text`` with each span replaced by ``mask(kind)``; of overlapping spans the first counts."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))

    def step(s: Column, x: Column) -> Column:
        inside = x["start"] < s["at"]
        done = F.concat(s["done"], F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), mask(x["kind"]))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(inside, s["done"]).otherwise(done).alias("done"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        ordered, zero, step, lambda s: F.concat(s["done"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))))


def with_spans(docs: DataFrame, tagger: Tagger | None = None, column: str = "pii") -> DataFrame:
    """Add the spans of ``text``; trains a tagger on ``docs`` unless one is given."""
    bounded_batches(docs.sparkSession)
    tagger = tagger or fit_tagger(docs)
    return docs.withColumn(column, F.coalesce(
        spans_column(F.col("text").cast("string"), tagger), F.array().cast(SPANS)))


def redacted(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets."""
    spans = unused(docs, "pii_spans")
    rows = with_spans(docs, tagger, spans)
    return rows.withColumn("text", masked(
        F.col("text"), F.col(spans), lambda k: F.concat(F.lit("<"), F.upper(k), F.lit(">")))).drop(spans)
