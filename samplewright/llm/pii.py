"""Personal data by patterns, checksums and context, in built-in functions only (operator 3).

A regular expression proposes spans of each kind; validators confirm them: Luhn for
payment cards, mod-97 for bank accounts, value ranges for addresses and digit counts
for phone numbers.  A bank account may be followed by capitals that look like more of it,
so it is tried with every end that the pattern allows.  A span's score is its kind's prior, raised by a nearby context word
before it.  Spans of the base kinds always stay; those of the added kinds stay from
``THRESHOLD`` on.

Every expression runs inside the scan's stage: no Python, no shuffle.  A cheap
necessary condition (such as an @ for mail) keeps rows without candidates from
the costlier patterns; possessive loops keep these linear and free of recursion.  Lists are
folded a block of ``BLOCK`` at a time, so what is appended to stays short, and the context of a span comes
from the pieces before it, not from the text's start: a long text of many hits costs little more than its length.

Defined results: null and empty texts have no spans; places are code points, ends
exclusive; spans come by start, then kind as listed in ``KINDS``; spans of different
kinds may overlap, and redaction covers an overlap once, under the first span's name;
repeated rows give repeated results, other columns pass through.  Of an account's valid
ends the one at its country's length counts, else the longest; no account starts inside another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplewright.functions.tokens import let

# What each kind looks like.  Loops are possessive where nothing that
# follows could match what they give back, so matches are those of the plain forms.
_LOCAL = "[A-Za-z0-9._%+-]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9]))",  # the rest is looked at, not passed
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
#: A necessary condition that is cheaper than the pattern.
GATES = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": lambda t: t.contains("+") & t.rlike(r"\+[0-9]"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11}"),
    "ssn": lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
}
KINDS = tuple(PATTERNS)
BASE = KINDS[:4]
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": "mail|contact|write|@",
    "ip": "ip|host|address|server|login",
    "card": "card|visa|master|credit|debit|pay|karte|tarjeta|carte",
    "phone": "phone|tel|call|mobile|fax|cell|telefon",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social|security|tax",
}
#: Account numbers' countries with their fixed lengths.
LENGTHS = """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18
FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25
MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24
SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30""".split()
#: What a context word within ``NEAR`` characters before the span adds to the score.
BOOST, NEAR, THRESHOLD = 0.3, 40, 0.5
#: Spans that are listed together before they join the others.
BLOCK = 256


def _blocks(items: Column) -> Column:
    """The list in consecutive lists of ``BLOCK``."""
    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK)), lambda k: F.slice(
        items, (k * BLOCK + 1).cast("int"), F.lit(BLOCK))))


def _right(text: Column) -> Column:
    return F.substring(text, F.greatest(F.char_length(text) - NEAR, F.lit(0)) + 1, F.lit(NEAR))


def _folded(piece: Column, seen: Column, hit: Column, step) -> Column:
    """The spans that ``step(state, n, hit, before)`` gives for the matches in order.

    ``piece`` runs from the last match's end (n characters), ``seen`` is what the pattern passed of it,
    ``hit`` the span's text, ``before`` the characters before ``seen``.  The state has the end of the
    piece before (``at``), what a step keeps (``free``) and the last characters (``tail``).
    """
    spans = "array<struct<start:int,end:int,before:string,hit:string>>"
    items = F.transform(F.arrays_zip(piece.alias("p"), seen.alias("s"), hit.alias("h")), lambda x: F.struct(
        F.char_length(x["p"]).alias("n"), x["h"].alias("hit"), _right(x["p"]).alias("last"),
        _right(F.substring(x["p"], F.lit(1), F.char_length(x["p"]) - F.char_length(x["s"]))).alias("gap")))

    def one(acc: Column, x: Column) -> Column:
        free, span = step(acc, x["n"], x["hit"], _right(F.concat(acc["tail"], x["gap"])))
        return F.struct((acc["at"] + x["n"]).alias("at"), free.alias("free"), _right(F.concat(acc["tail"], x["last"])).alias("tail"),
                        F.when(span.isNotNull(), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def fold(acc: Column, block: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), acc["free"].alias("free"), acc["tail"].alias("tail"), F.array().cast(spans).alias("out"))
        return let(F.aggregate(block, start, one), lambda r: F.struct(
            r["at"].alias("at"), r["free"].alias("free"), r["tail"].alias("tail"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("free"), F.lit("").alias("tail"), F.array().cast(f"array<{spans}>").alias("out"))
    return let(items, lambda x: F.coalesce(F.aggregate(_blocks(x), zero, fold, lambda acc: F.flatten(acc["out"])), F.array().cast(spans)))


def _span(start: Column, end: Column, before: Column, hit: Column) -> Column:
    return F.struct(start.alias("start"), end.alias("end"), before.alias("before"), hit.alias("hit"))


def _places(text: Column, pattern: str) -> Column:
    """Each match as (start, end, before, hit): every piece runs from the last match's end over a gap to the next match."""
    piece, hit = [F.regexp_extract_all(text, F.lit(f"(?s)\\G(.*?)({pattern})"), F.lit(k)) for k in (0, 2)]

    def step(acc: Column, n: Column, found: Column, before: Column) -> tuple[Column, Column]:
        end = acc["at"] + n
        return acc["free"], _span(end - F.char_length(found), end, before, found)

    return let(hit, lambda h: _folded(piece, h, h, step))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether the digits pass: every second one from the right doubled, 9 off above 9, the sum a multiple of 10."""
    digits = F.regexp_extract_all(F.reverse(_digits(hit)), F.lit("[0-9]"), F.lit(0))
    worth = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(hit: Column) -> Column:
    """Whether the account number, its first four characters last and letters as 10 to 35, leaves 1."""
    plain = F.regexp_replace(hit, " ", "")
    marks = F.regexp_extract_all(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), F.lit("[A-Z0-9]"), F.lit(0))
    left = F.aggregate(marks, F.lit(0), lambda a, c: F.when(c.between("0", "9"), a * 10 + F.ascii(c) - 48)
                       .otherwise(a * 100 + F.ascii(c) - 55) % 97)
    return left == 1


def _account(hit: Column) -> Column:
    """The valid account number that a candidate begins with, ending before one of its spaces or at its end; null without any."""
    words = F.split(hit, " ")

    def tried(k: Column) -> Column:
        begin = F.array_join(F.slice(words, F.lit(1), k), " ")
        n = F.length(F.regexp_replace(begin, " ", ""))
        of_country = F.concat(F.substring(begin, 1, 2), n.cast("string")).isin(*LENGTHS)
        return F.when((n >= 15) & mod97(begin), F.struct(of_country.alias("of_country"), n.alias("n"), begin.alias("hit")))

    return F.array_max(F.transform(F.sequence(F.lit(1), F.size(words)), tried))["hit"]


def _accounts(text: Column) -> Column:
    """As ``_places``, for account numbers: from the left, a start inside the last account does not count."""
    piece, head, rest = [F.regexp_extract_all(text, F.lit(f"(?s)\\G(.*?)({PATTERNS['iban']})"), F.lit(k)) for k in (0, 2, 3)]

    def step(acc: Column, n: Column, found: Column, before: Column) -> tuple[Column, Column]:
        start = acc["at"] + n - 4  # a piece ends behind the country code and check digits
        end = start + F.char_length(found)
        new = found.isNotNull() & (start >= acc["free"])
        return F.when(new, end).otherwise(acc["free"]), F.when(new, _span(start, end, before, found))

    return let(head, lambda h: _folded(piece, h, F.transform(F.zip_with(h, rest, lambda a, b: F.concat(a, b)), _account), step))


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^(?:{_PART}\.){{3}}{_PART}$")
    if kind == "card":
        return F.length(_digits(hit)).between(12, 19) & luhn(hit)
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    if kind == "ssn":
        return ~hit.rlike("^(?:000|666|9..)-|-00-|-0000$")
    return F.lit(True)


def _spans(kind: str, text: Column) -> Column:
    def scored(s: Column) -> Column:
        score = F.lit(PRIOR[kind]) + F.when(F.lower(s["before"]).rlike(CONTEXT[kind]), F.lit(BOOST)).otherwise(F.lit(0.0))
        return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
                        s["end"].alias("end"), F.least(score, F.lit(1.0)).alias("score"))

    places = _accounts(text) if kind == "iban" else F.filter(_places(text, PATTERNS[kind]), lambda s: _valid(kind, s["hit"]))
    found = F.transform(places, scored)
    if kind not in BASE:
        found = F.filter(found, lambda s: s["score"] >= THRESHOLD)
    none = F.expr("cast(array() as array<struct<start:int,rank:int,kind:string,end:int,score:double>>)")
    return F.when(GATES[kind](text), found).otherwise(none)


def with_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` with all spans of each text: start, rank of the kind, kind, end, score."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(out_col, F.array_sort(F.concat(*[_spans(kind, text) for kind in KINDS])))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets."""
    def fold(acc: Column, block: Column) -> Column:
        stop = F.greatest(acc["at"], F.array_max(F.transform(block, lambda s: s["end"])))

        def cut(part: Column) -> Column:
            """``part`` is the text from where the last block ended to where this one does."""
            def step(inner: Column, s: Column) -> Column:
                gap = F.substring(part, inner["at"] - acc["at"] + 1, s["start"] - inner["at"])
                shown = F.concat(inner["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
                return F.struct(F.greatest(inner["at"], s["end"]).alias("at"),
                                F.when(s["start"] >= inner["at"], shown).otherwise(inner["out"]).alias("out"))

            start = F.struct(acc["at"].alias("at"), F.lit("").alias("out"))
            return let(F.aggregate(block, start, step), lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], r["out"]).alias("out")))

        return let(F.substring(text, acc["at"] + 1, stop - acc["at"]), cut)

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(_blocks(spans), zero, fold, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))))


def spans_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
