"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, URL schemes and the
cue words of identifiers. A local parser at each anchor expands to the left and right, decides the
boundaries and validates (octets, Luhn, digit counts, IBAN check digits). The base kinds (email,
ip, card, phone) are exactly the leftmost non-overlapping matches of their patterns; url, secret
and account are added by the method. Work is linear in the text: every parser either consumes
what it reads or stops at a character that no later anchor of its kind can pass.

Defined results: a null text counts as empty (no spans); offsets are code points, end exclusive;
null or repeated ids and repeated rows are carried row by row; an empty table gives an empty
result. ``redact`` passes other columns through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oeeflow.llm.common import on_workers, slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "secret", "url")

#: Cue words that announce an identifier, and URL schemes.
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key")
ACCOUNT_CUES = ("iban",)
SCHEMES = ("http://", "https://", "ftp://")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"'`]+")
# after a cue: the rest of a compound key (behind a joint, or in camel case), then a closing quote,
# what parts key and value, an opening quote and the value; of an account, words like "number" or "is"
_KEY_REST = (re.compile(r"[A-Za-z0-9_-]*+"), re.compile(r"[A-Za-z0-9_]*+"))
_SECRET = re.compile(r"[\"']?[ \t]*+(?:=>|:=|[=:])[ \t]*+[\"']?([A-Za-z0-9_./+-]{8,})")
_ACCOUNT = re.compile(r"(?:[ \t_-]*+(?i:number|no|nr|code|is)\b\.?){0,3}[\"']?[ \t]*+(?:=>|[=:])?[ \t:]*+[\"']?"
                      r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{2,4}){3,8})")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _iban(account: str) -> bool:
    s = account.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    for kind, cues in (("secret", SECRET_CUES), ("account", ACCOUNT_CUES), ("scheme", SCHEMES)):
        for w in cues:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


_held: list = []


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end), by kind as in ``KINDS``, then start."""
    if not _held:
        _held.append(_automaton())
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email_end = ip_next = card_next = phone_end = secret_end = url_end = account_end = 0
    key_end, key_tried = [0, 0], -1
    # cues without regard to the case of A-Z; bytes.lower keeps every other character and all places
    for last, (anchor, size) in _held[0].iter(text.encode().lower().decode()):
        if anchor == "digit":
            if last >= card_next:
                m = _CARD.match(text, last)
                card_next = m.end() if m else last + 1
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and _luhn(digits):
                        found["card"].append(m.span())
            if last >= ip_next:
                m = _IP.match(text, last)
                if m:
                    ip_next = m.end()
                    if all(len(p) <= 3 and int(p) <= 255 for p in (g.lstrip("0") or "0" for g in m.groups())):
                        found["ip"].append(m.span())
                else:  # a start inside the same digits would fail alike
                    ip_next = _DIGITS.match(text, last).end()
        elif anchor == "at":
            m = _DOMAIN.match(text, last + 1)
            if m:
                left = last
                while left > email_end and text[left - 1] in _LOCAL:
                    left -= 1
                if left < last:
                    email_end = m.end()
                    found["email"].append((left, email_end))
        elif anchor == "plus":
            m = _PHONE.match(text, last) if last >= phone_end else None
            if m:
                phone_end = m.end()
                if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                    found["phone"].append(m.span())
        elif anchor == "secret":
            at = last + 1
            first = text[at:at + 1]
            if first in ("_", "-") or "A" <= first <= "Z":
                form = int(first not in ("_", "-"))
                if at >= key_end[form]:  # cues inside one key share its end
                    key_end[form] = _KEY_REST[form].match(text, at).end()
                at = key_end[form]
            m = _SECRET.match(text, at) if last >= secret_end and at != key_tried else None
            key_tried = at
            if m:
                secret_end = m.end()
                found["secret"].append(m.span(1))
        elif anchor == "account":
            m = _ACCOUNT.match(text, last + 1) if last >= account_end else None
            if m and _iban(m[1]):
                account_end = m.end()
                found["account"].append(m.span(1))
        elif last >= url_end:
            m = _URL.match(text, last + 1)
            if m:
                end = last + 1 + len(m[0].rstrip(".,;:!?)]}"))
                if end > last + 1:
                    found["url"].append((last + 1 - size, end))
                    url_end = end
    return [(k, s, e) for k in KINDS for s, e in sorted(found[k])]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_<kind>`` of the base kinds, ``spans`` (all, ``kind:start:end`` joined
    by commas) and ``base_spans`` (the base kinds alone)."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), *[T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS],
                           T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = {k: [] for k in BASE_KINDS}
            base, every = [], []
            for value in batch.column(1):
                spans = find_spans(value.as_py() or "")
                own = [x for x in spans if x[0] in BASE_KINDS]
                for k in BASE_KINDS:
                    counts[k].append(sum(1 for x in own if x[0] == k))
                base.append(_joined(own))
                every.append(_joined(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(counts[k], pa.int64()) for k in BASE_KINDS],
                 pa.array(base, pa.string()), pa.array(every, pa.string())],
                ["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_spans", "spans"])

    on_workers(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def redact_text(text: str) -> str:
    """Each span becomes ``[KIND]``; spans that overlap become one, named by the first."""
    spans = sorted((s, -e, k) for k, s, e in find_spans(text))
    if not spans:
        return text
    out, at, end = [], 0, -1
    for s, e, k in spans:
        e = -e
        if s < end:  # overlaps the span before it: both go under one name
            end = max(end, e)
            at = end
            continue
        out += [text[at:s], f"[{k.upper()}]"]
        at = end = e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced in ``text_col`` and, if there is one, ``length_col`` set to
    the new length in code points (a null text stays null). Other columns are untouched."""
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = names.index(text_col)
        for batch in slices(batches):
            texts = [None if v is None else redact_text(v) for v in batch.column(where).to_pylist()]
            cols = list(batch.columns)
            cols[where] = pa.array(texts, pa.string())
            if length_col in names:
                k = names.index(length_col)
                old = batch.column(k)
                cols[k] = pa.array([o if t is None else len(t) for t, o in zip(texts, old.to_pylist())], old.type)
            yield pa.RecordBatch.from_arrays(cols, names)

    on_workers(docs.sparkSession)
    return docs.mapInArrow(run, schema)

