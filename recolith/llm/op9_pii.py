"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus-digit pairs, digits, URL schemes and identifier
cues. From each anchor a deterministic local parser walks left and right to the boundaries of the value and
validates it. A run of digits is parsed once, from its first digit, whatever its number of anchors.

Base kinds (email, ip, card, phone) are leftmost and non-overlapping within their kind; a match that fails its
check is dropped with the text it covers. Added kinds: ``url_auth`` (user information in a URL), ``iban``
(country code, ISO 13616 check), ``account`` (6 to 20 digits, or letters and digits, after a cue such as
"account no"), ``ssn`` (3-2-4 digits after such a cue or alone with hyphens), ``secret`` (16 characters of a key or token, or
more, with letters and digits, after a cue such as "token" and a separator; 6 or more of any after "password" and a colon or equals sign). Schemes and cues count in any mix of ASCII
letter cases, user information at any length.

Defined results: a null or empty text has no spans. Offsets are code points, the end exclusive. Only the id and
text columns are read; rows are independent, so ties, copies, very long texts and empty tables need nothing.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from recolith.llm.runtime import trimmed

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url_auth", "iban", "account", "ssn", "secret")
#: Schemes and cues, in lower case.
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "sftp://", "ssh://", "postgres://", "mysql://", "mongodb://", "redis://", "amqp://")
CUES = ("account no", "account number", "account:", "acct no", "acct:", "iban", "passport no", "passport number", "routing no", "routing number", "ssn", "social security")

KEYS = ("token", "api_key", "api-key", "apikey", "api key", "access_key", "access key", "secret", "secret_key", "bearer")
PASSWORDS = ("password", "passwd", "passphrase")

_DIGITS = "0123456789"
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_groups = re.compile(r"[0-9]+(?:\.[0-9]+)*").match
_spaced = re.compile(r"[0-9](?:[ -]?[0-9])*").match
_dial = re.compile(r"[ ().0-9-]+").match
_authority = re.compile(r"[^\s/?#@]++@[A-Za-z0-9.-]+").match
_iban = re.compile(r"[ :#.]*(?ai:no\.?|number)?[ :#.]*([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])").match
_value = re.compile(r"[ .:#]*(?:(?ai:is|no|number)\b)?[ .:#]*([A-Z]{0,2}[0-9](?:[ -]?[0-9]){5,19})(?![A-Za-z0-9])").match
_ssn = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])").match
_key = re.compile(r"[\"']?[ \t:=\"']+([A-Za-z0-9_+/=.-]{16,})").match
_password = re.compile(r"[\"']?[ \t]*[:=][ \t]*[\"']?([^\s\"',;]{6,})").match
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban_ok(value: str) -> bool:
    compact = value.replace(" ", "")
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _machine():
    import ahocorasick

    a = ahocorasick.Automaton()
    a.add_word("@", ("@", 1))
    for d in _DIGITS:
        a.add_word(d, ("d", 1))
        a.add_word("+" + d, ("+", 2))
    for s in SCHEMES:
        a.add_word(s, ("s", len(s)))
    for kind, cues in (("c", CUES), ("k", KEYS), ("p", PASSWORDS)):
        for s in cues:
            a.add_word(s, (kind, len(s)))
    a.make_automaton()
    return a


_machines: list = []


def _lower(text: str) -> str:
    """The text with ASCII letters in lower case, so that offsets stay."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def find(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every span, by start, then kind as listed."""
    if not text:
        return []
    if not _machines:
        _machines.append(_machine())
    spans: list[tuple[int, int, str]] = []
    mail_end = dots_end = card_end = secret_end = 0
    n = len(text)
    for last, (what, width) in _machines[0].iter(_lower(text)):
        at = last + 1 - width
        if what == "d":
            if at >= dots_end:
                m = _groups(text, at)
                dots_end = m.end()
                parts = m.group().split(".")
                if len(parts) >= 4:
                    pos = at
                    for k in range(0, len(parts) - 3, 4):
                        four = parts[k : k + 4]
                        end = pos + sum(map(len, four)) + 3
                        if all(len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255 for p in four):
                            spans.append((pos, end, "ip"))
                        pos = end + 1
            if at >= card_end:
                m = _spaced(text, at)
                card_end = m.end()
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    spans.append((at, card_end, "card"))
                if len(digits) == 9 and card_end - at == 11 and (s := _ssn(text, at)) and s[1] not in ("000", "666") and s[1] < "900" and s[2] != "00" and s[3] != "0000" and (not at or text[at - 1] not in "-+."):
                    spans.append((at, card_end, "ssn"))
        elif what == "@":
            start = at
            while start > mail_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _domain(text, at + 1)):
                mail_end = m.end()
                spans.append((start, mail_end, "email"))
        elif what == "+":
            if m := _dial(text, at + 2):
                end = m.end()
                while end > at + 3 and text[end - 1] not in _DIGITS:
                    end -= 1
                if end > at + 3 and 9 <= sum(c in _DIGITS for c in text[at:end]) <= 15:
                    spans.append((at, end, "phone"))
        elif what == "s":
            if m := _authority(text, last + 1):
                spans.append((last + 1, text.index("@", last + 1), "url_auth"))
        elif what in "kp":
            if last + 1 >= secret_end and (m := (_key if what == "k" else _password)(text, last + 1)):
                secret_end = m.end()  # a run is read once, whatever its number of cues
                if what == "p" or (any(c in _DIGITS for c in m[1]) and any(c.isalpha() for c in m[1])):
                    spans.append((m.start(1), m.end(1), "secret"))
        elif last + 1 < n:
            if (m := _iban(text, last + 1)) and iban_ok(m[1]):
                spans.append((m.start(1), m.end(1), "iban"))
            elif m := _value(text, last + 1):
                spans.append((m.start(1), m.end(1), "account"))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(set(spans), key=lambda x: (x[0], order[x[2]], x[1]))


def spell(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text: counts of the base kinds, the digest of the base spans, all spans and their number."""

    @trimmed
    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in batch.column(1).to_pylist():
                spans = find(text)
                base = [x for x in spans if x[2] in BASE]
                for k, kind in enumerate(BASE):
                    out[k].append(sum(x[2] == kind for x in base))
                out[4].append(hashlib.sha256(spell(base).encode()).hexdigest())
                out[5].append(spell(spans))
                out[6].append(len(spans))
            columns = [pa.array(x, pa.string() if k in (4, 5) else pa.int64()) for k, x in enumerate(out)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"])

    schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_spans bigint"
    return df.select(id_col, text_col).mapInArrow(run, schema)


def mask(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with every span replaced by its kind in brackets; of overlapping spans the first counts."""

    def hide(text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for a, b, kind in find(text):
            if a >= at:
                out += [text[at:a], f"[{kind.upper()}]"]
                at = b
        return "".join(out) + text[at:]

    @trimmed
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([hide(t) for t in batch.column(1).to_pylist()], pa.string())], [id_col, text_col])

    return df.select(id_col, text_col).mapInArrow(run, f"{id_col} {df.schema[id_col].dataType.simpleString()}, {text_col} string")
