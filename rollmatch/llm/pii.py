"""Personal data in text: patterns propose spans, validators and nearby words decide.

Base kinds (email, ip, card, phone) are the leftmost non-overlapping matches of their
pattern that pass their check (parts up to 255, Luhn, number of digits); a match that
fails is dropped without a retry. Beyond them the scored kinds (iban with its mod-97
check, social security numbers, phone numbers in national form) start from a prior and
gain from a passed checksum and from context words near the span; those that reach
``threshold`` and touch no span found before are added. An iban has the length of its country
(any length where the country is not in the table), so what follows it does not count; numbers of
areas, groups or serials that are never issued are no social security numbers.

All patterns run in time linear in the text. Positions are code points, end exclusive.
NULL and empty texts have no spans.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.llm.common import per_text

#: Order of the kinds in results.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){12,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NATIONAL = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")

#: Characters of an iban by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24,
    "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}

#: Words that raise the score of a span of their kind when they stand nearby.
CONTEXT = {
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "téléphone", "teléfono"),
}
#: Scores: before any evidence, for a passed checksum, for a context word within WINDOW characters.
PRIOR = {"iban": 0.3, "ssn": 0.4, "phone": 0.3}
CHECKSUM, NEARBY, WINDOW, THRESHOLD = 0.5, 0.4, 48, 0.7


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if k % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    rest = 0
    for c in moved:
        rest = (rest * (10 if c.isdigit() else 100) + int(c, 36)) % 97
    return rest == 1


def emails(text: str):
    """Matches of ``[local]+@label(.label)+``, found from each @ so that long runs cost no retries."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


def ibans(text: str):
    """(start, end) of spans that have their country's length and pass mod-97; a failing one is tried again
    from its next group. A candidate has at most 40 characters, so time is linear."""
    m = _IBAN.search(text)
    while m:
        end = m.end()
        most = IBAN_LENGTH.get(text[m.start():m.start() + 2])
        if most:
            places = [k for k in range(m.start(), end) if text[k] != " "]
            end = places[most - 1] + 1 if len(places) >= most else 0
        if end and not text[end:end + 1].isalnum() and mod97(text[m.start():end].replace(" ", "")):
            yield m.start(), end
        else:
            end = m.start() + 1
        m = _IBAN.search(text, end)


def _issued(ssn: str) -> bool:
    return ssn[:3] not in ("000", "666") and ssn[0] != "9" and ssn[4:6] != "00" and ssn[7:] != "0000"


def _merged(spans) -> list[tuple[int, int]]:
    """Disjoint intervals, ascending, that cover the same places."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scored_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int, float]]:
    """Spans of the scored kinds that touch none of ``taken``; candidates and taken spans are swept in order."""
    found = []
    held = _merged((a, b) for _, a, b in taken)
    candidates = {
        "iban": ibans(text),
        "ssn": (m.span() for m in _SSN.finditer(text) if _issued(m.group())),
        "phone": (m.span() for m in _NATIONAL.finditer(text)),
    }
    for kind, spans in candidates.items():
        new, k = [], 0
        for a, b in spans:
            while k < len(held) and held[k][1] <= a:
                k += 1
            if k < len(held) and held[k][0] < b:
                continue
            score = PRIOR[kind] + (CHECKSUM if kind == "iban" else 0)
            near = text[max(0, a - WINDOW):a] + " " + text[b:b + WINDOW]
            if any(w in CONTEXT[kind] for w in re.findall(r"\w+", near.lower())):
                score += NEARBY
            if score >= THRESHOLD:
                found.append((kind, a, b, score))
                new.append((a, b))
        held = _merged(held + new)
    return found


def find_spans(text: str) -> list[dict]:
    base = base_spans(text)
    spans = [(k, a, b, 1.0, True) for k, a, b in base]
    if any("0" <= c <= "9" for c in text):
        spans += [(*s, False) for s in scored_spans(text, base)]
    spans.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return [{"kind": k, "start": a, "end": b, "score": s, "base": f} for k, a, b, s, f in spans]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``spans`` (array of kind, start, end, score, base), by kind and start."""
    found = per_text(lambda: lambda t: (find_spans(t),), "spans array<struct<kind:string,start:int,end:int,score:double,base:boolean>>")
    return docs.select(F.col(id_col), found(F.col(text_col))["spans"].alias("spans"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
