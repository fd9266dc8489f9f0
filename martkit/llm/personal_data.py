"""Personal data: patterns propose spans, checksums confirm them, the words
nearby adjust a score.

Base kinds: email, ip (parts at most 255), card (14 to 19 digits, Luhn), phone
(a plus sign and 10 to 15 digits). The method adds iban (mod-97). Offsets are
code points, the end is exclusive. Every pattern is searched in time linear in
the text, also in long runs of digits or letters: an address is looked for
around each ``@``, and a number only where a run of digits begins.

Defined cases: a null text counts as empty; spans of different kinds may
overlap; of equal texts each row gets the same spans; other columns are
untouched; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from martkit.llm.common import cells, give_back

#: In the order in which spans with the same start are listed.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match ends where a run of digits ends, so the next one begins with a run.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Score of a confirmed span in hundredths, before the words around it count.
SCORES = {"email": 90, "ip": 60, "card": 85, "phone": 70, "iban": 95}
_NEAR = 40
_FOR = {
    "email": ("mail", "email", "contact", "write to"),
    "ip": ("ip", "address", "server", "host", "login"),
    "card": ("card", "visa", "credit", "payment", "amex", "mastercard"),
    "phone": ("phone", "telephone", "tel", "call", "mobile", "fax", "contact"),
    "iban": ("iban", "bank", "account", "transfer"),
}
_AGAINST = {
    "email": ("example", "noreply"),
    "ip": ("version", "release", "section", "chapter"),
    "card": ("order", "serial", "isbn", "part number"),
    "phone": ("order", "serial", "invoice"),
    "iban": ("sample", "example"),
}


def _words(words: tuple[str, ...]) -> re.Pattern:
    """Any of the words as a whole, also in the plural."""
    return re.compile(rf"(?<![^\W\d_])(?:{'|'.join(words)})(?:e?s)?(?![^\W\d_])", re.IGNORECASE)


_FOR_RE, _AGAINST_RE = ({k: _words(w) for k, w in x.items()} for x in (_FOR, _AGAINST))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def mod97(text: str) -> bool:
    """The ISO 13616 check: country and check digits last, letters as numbers."""
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _emails(text: str):
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and _is_local(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def _is_local(c: str) -> bool:
    return c in "._%+-" or (c.isascii() and c.isalnum())


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of one text, by start and kind."""
    found = [("email", a, b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    found.append(("phone", *m.span()))
        for m in _IBAN.finditer(text):
            plain = m[0].replace(" ", "")
            if 15 <= len(plain) <= 34 and mod97(plain):
                found.append(("iban", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def score(text: str, kind: str, start: int, end: int) -> float:
    """Confidence of a confirmed span: whole words within 40 characters speak for
    it or against it. Counted in hundredths, so that sums are exact."""
    first = max(0, start - _NEAR)
    # One character more on either side tells where a word begins or ends.
    skip = min(1, first)
    before, after = text[first - skip : start], text[end : end + _NEAR + 1]

    def beside(word: re.Pattern) -> bool:
        m = word.search(after)
        return bool(word.search(before, skip) or (m and m.end() <= _NEAR))

    return min(100, max(0, SCORES[kind] + 10 * beside(_FOR_RE[kind]) - 20 * beside(_AGAINST_RE[kind]))) / 100


def mask(text: str, found: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind; of overlapping spans the
    union is replaced, by the kind that begins first."""
    out, done, end, kind = [], 0, -1, ""
    for k, a, b in [*found, ("", len(text) + 1, 0)]:
        if a >= end:
            if end >= 0:
                out.append(f"<{kind.upper()}>")
                done = end
            if not k:
                break
            out.append(text[done:a])
            kind, end = k, b
        else:
            end = max(end, b)
    out.append(text[done:])
    return "".join(out)


_SPAN = ArrayType(
    StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("score", DoubleType())])
)
_ROWS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


@F.arrow_udf(_SPAN)
def _find(texts: pa.Array) -> pa.Array:
    out = []
    for text in texts.to_pylist():
        found = spans(text) if text else []
        out.append([{"kind": k, "start": a, "end": b, "score": score(text, k, a, b)} for k, a, b in found])
    return pa.array(out, _ROWS)


@F.arrow_udf(StringType())
def _masked(texts: pa.Array, least: pa.Array) -> pa.Array:
    out = []
    for text, bound in zip(cells(texts), cells(least)):
        if text:
            text = mask(text, [s for s in spans(text) if score(text, *s) >= bound])
        out.append(text)
    give_back()
    return pa.array(out, pa.string())


def find_personal_data(docs: DataFrame, text: str = "text", out: str = "found") -> DataFrame:
    """``docs`` with an array of confirmed spans: kind, start, end, score."""
    return docs.withColumn(out, _find.asNondeterministic()(F.col(text).cast("string")))


def mask_personal_data(docs: DataFrame, text: str = "text", least: float = 0.0) -> DataFrame:
    """``docs`` with every span of at least that score replaced in the text by
    ``<KIND>``; null texts stay null."""
    return docs.withColumn(text, _masked.asNondeterministic()(F.col(text).cast("string"), F.lit(float(least))))


def span_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of the base
    spans and the list of all spans."""
    found = find_personal_data(docs.select("doc_id", "text"))

    def listed(which) -> Column:
        as_text = F.transform(which, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(as_text, ",")

    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        F.round(F.aggregate("found", F.lit(0.0), lambda a, s: F.greatest(a, s["score"])), 6).alias("top_score"),
    )


def digest(found: list[tuple[str, int, int]]) -> str:
    """The digest of ``span_report`` for one list of spans."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found if k in BASE).encode()).hexdigest()
