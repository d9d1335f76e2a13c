"""Operator 6: personal data by pattern, checksum and context.

Regular expressions propose spans; validators confirm them (Luhn; mod-97; the ranges in
which local phone numbers and social security numbers are given out); whole words near a
weak proposal, in seven languages, raise or lower its score. The four
base kinds need no context. Further kinds are reported from ``min_score`` up
and never overlap a base span. Names, addresses, dates of birth, other countries' national
numbers and local phone numbers of other plans are not looked for.

Every pattern is linear in the text: a run is entered at its first character
only. Offsets are code points, end exclusive. Null or empty text: no spans.
Rows with a null or repeated doc_id are scanned and returned like any other;
an empty table gives an empty result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm.common import documents, id_text, map_texts, sha

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "short_card", "local_phone", "national_id")

_LOCAL, _HOST = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_EMAIL_AT = re.compile(rf"{_LOCAL}++@{_HOST}")
_EMAIL = re.compile(rf"(?<!{_LOCAL}){_LOCAL}++@{_HOST}")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Lengths of the countries' IBANs, blanks not counted.
IBAN_LENGTH = {country: n for n, said in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for country in said.split()}
#: Ten digits of the North American plan: area and exchange codes start with 2 to 9 and do not
#: end in 11, and no area code has a 9 in the middle.
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[2-9](?!11)[0-8][0-9]\)?[\x20.-][2-9](?!11)[0-9]{2}[.-][0-9]{4}(?![0-9])")
#: Area, group and serial of a social security number: never 000, 666 or 9xx, never 00, never 0000.
_NATIONAL = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

#: Words that raise the score of a kind when they stand within CONTEXT
#: characters before it or half as many behind it.
CONTEXT = 48
def _words(said: str) -> re.Pattern:
    """Any of the words (with a plural s) or phrases, whole."""
    return re.compile(rf"(?<!\w)(?:{'|'.join(sorted(map(re.escape, said.split(', ')), key=len, reverse=True))})s?(?!\w)", re.I)


NEAR = {
    "iban": _words("iban, bic, swift, bank, bank account, account, konto, kontonummer, bankverbindung, cuenta, compte, conto, conta, "
                   "rekening, rekeningnummer"),
    "short_card": _words("card, credit card, debit card, visa, amex, american express, diners, credit, debit, karte, kreditkarte, "
                         "tarjeta, carte, carte bancaire, carta, cartão, kaart"),
    "local_phone": _words("phone, telephone, tel, call, mobile, cell, fax, contact, text, telefon, handy, téléphone, teléfono, móvil, "
                          "telefono, cellulare, telefone, telemóvel, telefoon, llamar, appeler, anrufen"),
    "national_id": _words("ssn, social security, social security number, social, national id, tax id, taxpayer, passport, ausweis, "
                          "sozialversicherungsnummer, seguro social, sécurité sociale, numéro de sécurité sociale, codice fiscale"),
}
#: Words that lower it.
AGAINST = _words("order, order no, invoice, version, isbn, issn, serial, serial no, ticket, part, part no, sku, tracking, reference, "
                 "bestellung, rechnung, auftrag, pedido, factura, commande, facture, ordine, fattura, bestelling, factuur")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _digits(s: str) -> str:
    return s.replace(" ", "").replace("-", "")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, never overlapping: a local part starts at the start of
    its run, or where the match before it ended."""
    out, at = [], 0
    if "@" not in text:
        return out
    while m := (at and _EMAIL_AT.match(text, at)) or _EMAIL.search(text, at):
        out.append(m.span())
        at = m.end()
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds: kinds in their fixed order, then by start."""
    out = [("email", *s) for s in _emails(text)]
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.groups()):
                out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def _ibans(text: str) -> list[tuple[int, int]]:
    """IBANs by mod-97. A proposal may hold words or numbers that follow the IBAN:
    it is tried at its country's length first, if that ends at a blank, then
    whole. After a proposal without IBAN the search goes on inside it."""
    out, at = [], 0
    while m := _IBAN.search(text, at):
        said, at = m[0], m.start() + 1
        ends = [k for k in range(len(said)) if said[k] == " "] + [len(said)]
        fixed = [k for k in ends if k - said.count(" ", 0, k) == IBAN_LENGTH.get(said[:2])]
        for k in (*fixed, len(said)):
            if mod97(said[:k]):
                at = m.start() + k
                out.append((m.start(), at))
                break
    return out


def _score(kind: str, base: float, text: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT):start] + "\n" + text[end:end + CONTEXT // 2]
    return base + 0.4 * bool(NEAR[kind].search(near)) - 0.3 * bool(AGAINST.search(near))


def more_spans(text: str, taken: list[tuple[str, int, int]], min_score: float) -> list[tuple[str, int, int, float]]:
    """Weaker kinds: checksum, then context; none that overlaps ``taken`` or an
    earlier one of these."""
    found = [("iban", 0.9, s) for s in _ibans(text)]
    found += [("short_card", 0.3, m.span()) for m in _CARD.finditer(text)
              if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 15 and luhn(d)]
    found += [("local_phone", 0.3, m.span()) for m in _LOCAL_PHONE.finditer(text)]
    found += [("national_id", 0.3, m.span()) for m in _NATIONAL.finditer(text)]
    if not found:
        return []
    busy, out = [s[1:] for s in taken], []
    for kind, base, (s, e) in found:
        score = _score(kind, base, text, s, e)
        if score >= min_score and not any(a < e and s < b for a, b in busy):
            out.append((kind, s, e, score))
            busy.append((s, e))
    return out


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_score: float = 0.6) -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, end, score) per document.

    Base kinds first (score 1), each in the order of BASE_KINDS + MORE_KINDS,
    then by start.
    """
    def row(text: str) -> tuple:
        base = base_spans(text)
        more = sorted(more_spans(text, base, min_score), key=lambda s: (MORE_KINDS.index(s[0]), s[1]))
        return ([{"kind": k, "start": s, "end": e, "score": 1.0} for k, s, e in base]
                + [{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in more],)

    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    return map_texts(id_text(docs, id_col, text_col), row, [("spans", pa.list_(span))],
                     "spans array<struct<kind:string,start:long,end:long,score:double>>")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of ``pii_spans`` over all of ``documents``."""
    spans = pii_spans(documents(spark, sf_dir))
    said = "transform({}, s -> concat_ws(':', s.kind, s.start, s.end))"
    base = f"filter(spans, s -> s.kind in {BASE_KINDS})"
    return spans.selectExpr(
        "doc_id", *(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long) as n_{k}" for k in BASE_KINDS),
        f"sha2(array_join({said.format(base)}, ','), 256) as base_sha256",
        f"array_join({said.format('spans')}, ',') as spans")
