"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust a score.

The base kinds (email, ip, card, phone) are fixed by their expressions and checks and always stay; their score tells
how sure a reader can be. The method adds bank accounts (iban, confirmed by mod 97), national numbers (ssn) and
secrets (access tokens and keys: long runs of letters and digits whose characters are spread as random ones are).
An added span stays if its score reaches ``MIN_SCORE``: words near it, in the four languages of the documents, raise
the score or lower it, the nearer the more. A number alone is no ssn and a run alone no secret, and a valid account
in an example is dropped. Every scan is linear in the text: expressions start at the beginning of a run only.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE_KINDS = KINDS[:4]
CONTEXT_CHARS = 40
MIN_SCORE = 0.5
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "secret": 0.3}
# words near a span that speak for its kind: English, German, French, Spanish
CONTEXT_FOR = {
    "email": "mail email contact write kontakt schreiben adresse contacter courriel correo contacto escribir",
    "ip": "ip address host server login adresse rechner serveur connexion servidor conexión",
    "card": "card visa mastercard credit payment karte kreditkarte zahlung carte crédit paiement tarjeta crédito pago",
    "phone": "phone tel call mobile fax telefon anruf handy téléphone appeler portable teléfono llamar móvil",
    "iban": "iban account bank transfer konto überweisung compte virement banque cuenta banco transferencia",
    "ssn": "ssn social security taxpayer sozialversicherung steuer sécurité sociale seguridad contribuyente",
    "secret": "token secret key password bearer apikey api passwort schlüssel geheim jeton clé passe clave contraseña secreto",
}
CONTEXT_FOR = {kind: frozenset(words.split()) for kind, words in CONTEXT_FOR.items()}
# and those that speak against it
CONTEXT_AGAINST = frozenset("example sample version invoice order isbn part checksum commit beispiel muster rechnung bestellung teil exemple facture "
                            "commande pièce ejemplo factura pedido pieza".split())
STEP_FOR, STEP_AGAINST = 0.3, 0.4
NEAR_CHARS = 15  # words beyond count half
MIN_BITS = 2.8  # per character of a secret; sixteen digits evenly used have four

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# a match can't begin inside a run of digits: it would have begun where the run begins
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,200}+(?![A-Za-z0-9_+/-])")
_WORD = re.compile(r"[^\W\d_]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod_97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def random_like(run: str) -> bool:
    """Letters and digits, mixed as in a random run: as many bits a character, and digits all over it."""
    digits = sum("0" <= c <= "9" for c in run)
    if not 0.1 * len(run) <= digits < len(run):
        return False
    bits = -sum(n / len(run) * math.log2(n / len(run)) for n in Counter(run.lower()).values())
    return bits >= MIN_BITS


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, one try per @: the part before it can't hold another."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = at + 1
        at = text.find("@", max(at + 1, free))


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in _emails(text):
        yield "email", start, end
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span()
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            yield "phone", *m.span()
    for m in _IBAN.finditer(text):
        compact = m.group().replace(" ", "")
        if 15 <= len(compact) <= 34 and mod_97(compact):
            yield "iban", *m.span()
    for m in _SSN.finditer(text):
        yield "ssn", *m.span()
    for m in _SECRET.finditer(text):
        if random_like(m.group()):
            yield "secret", *m.span()


def _context(kind: str, text: str, start: int, end: int) -> float:
    """What the words near a span add to its score: the nearest word for its kind, less the nearest one against it
    unless that is further off (the ``example`` of an address behind the span speaks of the address)."""
    raised = lowered = CONTEXT_CHARS + 1
    for gap, word in _words_near(text, start, end):
        if word in CONTEXT_FOR[kind]:
            raised = min(raised, gap)
        if word in CONTEXT_AGAINST:
            lowered = min(lowered, gap)

    def share(gap: int) -> float:
        return 0.0 if gap > CONTEXT_CHARS else 1.0 if gap <= NEAR_CHARS else 0.5
    return STEP_FOR * share(raised) - STEP_AGAINST * (share(lowered) if lowered <= raised else 0.0)


def _words_near(text: str, start: int, end: int) -> Iterator[tuple[int, str]]:
    """Whole words within ``CONTEXT_CHARS`` characters, in lower case, with their distance from the span."""
    lo = max(0, start - CONTEXT_CHARS)
    for m in _WORD.finditer(text[lo:start].lower()):
        yield start - lo - m.end(), m.group()
    for m in _WORD.finditer(text[end:end + CONTEXT_CHARS].lower()):
        yield m.start(), m.group()


def find(text: str | None) -> list[Span]:
    """Spans by kind in the order of ``KINDS``, then start; code points, end exclusive. Null text: none."""
    out = []
    for kind, start, end in _proposed(text or ""):
        score = BASE_SCORE[kind] + _context(kind, text, start, end)
        if kind in BASE_KINDS or round(score, 2) >= MIN_SCORE:
            out.append(Span(kind, start, end, round(min(1.0, max(0.0, score)), 2)))
    return out


def _run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    for b in batches(it):
        spans = [[s._asdict() for s in find(t)] for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "spans": pa.array(spans, kind)})


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and the array of spans (kind, start, end, score) of the whole text.

    Null and empty texts have an empty array; null ids and repeated rows stay as they are; other columns are
    ignored. One pass over the texts, no shuffle.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_run, f"doc_id long, spans {SPANS}")
